"""Hidden Markov language model: Baum-Welch over all training texts, exact scaled forward scores.

Observations are the FREQUENT commonest training tokens, each a symbol of its own, and one symbol for all other tokens, which
then has the probability of the token within that rest (add-one counts). Token counts of any number are counted and joined
by Spark; only the counts of the KNOWN commonest tokens (a fixed number) are sent to tasks.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Seen, fold, map_batches, rows_of, table, texts, written

FREQUENT, KNOWN, STATES, ROUNDS = 4096, 1 << 18, 6, 4
#: Training ends after ROUNDS, or when the log likelihood of a token gains less than this.
GAIN = 1e-3
FOLDS, HELD = 7, 2
#: Training follows texts in pieces of so many tokens, each begun from the state shares; scores follow whole texts.
PIECE = 512
CELLS = 1 << 20
#: No word holds a blank, so this is no word.
END = b"\n"
LOG10 = np.log(10)


def tokens_of(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased, then the end."""
    return [*text.encode().lower().split(), END] if text else [END]


def key_of(token: bytes) -> int:
    """64 bits of the token, signed."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(token)).astype(np.int64))


def token_counts(docs: DataFrame) -> DataFrame:
    """key and n of each distinct token of doc_id, text; counted within tasks first, with a bound on what a task holds."""

    def count(batches):
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_pydict({"key": pa.array([key_of(w) for w in held], pa.int64()), "n": pa.array(list(held.values()), pa.int64())})

        for batch in batches:
            for part in rows_of(batch):
                for text in part.column("text").to_pylist():
                    held.update(tokens_of(text))
                if len(held) > Seen.most:
                    yield out()
                    held.clear()
        yield out()

    return docs.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def commonest(counts: DataFrame, most: int) -> list[tuple[int, int]]:
    """(key, n) of the commonest tokens, the commonest first, ties by key: all of the levels of n from the top that hold `most`
    or fewer together. Levels are the numbers up to 1,024 and then 64ths of a power of two, a few thousand whatever the corpus;
    only rows above the cut leave Spark."""
    level = F.when(F.col("n") < 1024, F.col("n").cast("double")).otherwise(384 + F.floor(F.log2("n") * 64))
    own, held, cut = counts.withColumn("level", level), 0, None
    for r in own.groupBy("level").count().orderBy(F.desc("level")).collect():
        held += r["count"]
        if held > most:
            break
        cut = r.level
    if cut is None:
        return []
    return sorted(((r.key, r.n) for r in own.where(F.col("level") >= cut).select("key", "n").collect()), key=lambda x: (-x[1], x[0]))


def encoded(docs: DataFrame, common: list[tuple[int, int]], frequent: int) -> DataFrame:
    """docs' rows as symbols. common: (key, count) of the commonest tokens, the commonest first."""
    sent = docs.sparkSession.sparkContext.broadcast((np.array([k for k, _ in common], np.int64), np.array([n for _, n in common], np.int64)))

    def make():
        keys, counts = sent.value
        place = {int(k): i for i, k in enumerate(keys)}
        logs = np.log10(counts + 1.0)
        top = min(frequent, len(keys))
        seen = Seen()
        rare: list[int] = []

        def step(cols):
            names = ("symbols", "n_tokens", "n_known", "n_rest", "log_all", "log_rest", "keys", "tf")
            out: dict = {"doc_id": cols["doc_id"], "held_out": cols["held_out"]} | {n: [] for n in names}
            for text in cols["text"]:
                words = tokens_of(text)
                new = seen.missing(words)
                if not seen:
                    rare.clear()
                for w in new:
                    k = key_of(w)
                    # Commonest tokens by their place, others by numbers below 0.
                    if (at := place.get(k)) is None:
                        rare.append(k)
                        at = -len(rare)
                    seen[w] = at
                at = np.fromiter(map(seen.__getitem__, words), np.int64, len(words))
                known, rest = at >= 0, (at < 0) | (at >= top)
                far, tf = np.unique(-at[~known] - 1, return_counts=True)
                out["symbols"].append(np.where(rest, top, at).astype("<u2").tobytes())
                out["n_tokens"].append(len(words))
                out["n_known"].append(int(known.sum()))
                out["n_rest"].append(int(rest.sum()))
                out["log_all"].append(float(logs[at[known]].sum()))
                out["log_rest"].append(float(logs[at[known & rest]].sum()))
                out["keys"].append([rare[i] for i in far.tolist()])
                out["tf"].append(tf.tolist())
            yield out

        return step

    return map_batches(docs, make, "doc_id long, held_out boolean, symbols binary, n_tokens long, n_known long, n_rest long, log_all double, log_rest double, keys array<long>, tf array<int>")


class Model:
    """start (K), step (K, K) and emit (K, S) probabilities."""

    def __init__(self, start: np.ndarray, step: np.ndarray, emit: np.ndarray):
        self.start, self.step, self.emit = start, step, emit

    @classmethod
    def first(cls, counts: np.ndarray, states: int) -> Model:
        rng = np.random.default_rng(1)
        emit = (counts + 1.0) * rng.lognormal(0, 0.7, (states, len(counts)))
        step = rng.lognormal(0, 0.5, (states, states)) + np.eye(states)
        return cls(np.full(states, 1 / states), step / step.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))

    @classmethod
    def of(cls, counts: np.ndarray, states: int, symbols: int) -> Model:
        """From expected counts laid end to end, each with a little added so that nothing is impossible."""
        start, step, emit, _ = np.split(counts, [states, states + states * states, -1])
        step, emit = step.reshape(states, states) + 0.1, emit.reshape(states, symbols) + 0.1
        return cls((start + 0.1) / (start + 0.1).sum(), step / step.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))

    def packed(self, seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sequences time by time, the longest first: symbols, number still running at each time, offsets, order."""
        order = np.argsort([-len(s) for s in seqs], kind="stable")
        size = np.array([len(seqs[i]) for i in order])
        alive = np.searchsorted(-size, -np.arange(size[0]), side="left")
        at = np.concatenate([[0], np.cumsum(alive)])
        flat = np.empty(at[-1], np.int64)
        row = np.arange(len(order))
        for r in row:
            flat[at[: size[r]] + r] = seqs[order[r]]
        return flat, alive, at, order

    def scores(self, seqs: list[np.ndarray]) -> np.ndarray:
        """Natural log probability of each whole sequence by the scaled forward recursion."""
        flat, alive, at, order = self.packed(seqs)
        emit, out = np.ascontiguousarray(self.emit.T), np.zeros(len(seqs))
        a = np.broadcast_to(self.start, (len(seqs), len(self.start)))
        for t, n in enumerate(alive):
            a = (a[:n] @ self.step if t else a[:n]) * emit[flat[at[t] : at[t] + n]]
            c = a.sum(1)
            a = a / c[:, None]
            out[:n] += np.log(c)
        back = np.empty(len(seqs))
        back[order] = out
        return back

    def expected(self, seqs: list[np.ndarray], first: np.ndarray) -> np.ndarray:
        """Expected start, step and emission counts and, last, the log likelihood; first: which sequences begin a text."""
        flat, alive, at, order = self.packed(seqs)
        k, s = self.emit.shape
        obs = np.ascontiguousarray(self.emit.T)[flat]
        fwd, scale = np.empty((len(flat), k)), np.empty(len(flat))
        a = np.broadcast_to(self.start, (len(seqs), k))
        for t, n in enumerate(alive):
            here = slice(at[t], at[t] + n)
            a = (a[:n] @ self.step if t else a[:n]) * obs[here]
            scale[here] = c = a.sum(1)
            fwd[here] = a = a / c[:, None]
        pairs, gamma = np.zeros((k, k)), np.empty((len(flat), k))
        beta = np.ones((0, k))
        for t in range(len(alive) - 1, -1, -1):
            n, here = alive[t], slice(at[t], at[t] + alive[t])
            now = np.ones((n, k))
            if len(beta):
                m = len(beta)
                then = slice(at[t + 1], at[t + 1] + m)
                right = obs[then] * beta / scale[then][:, None]
                pairs += fwd[here][:m].T @ right
                now[:m] = right @ self.step.T
            gamma[here] = fwd[here] * now
            beta = now
        emit = np.stack([np.bincount(flat, gamma[:, i], minlength=s) for i in range(k)])
        start = gamma[: alive[0]][first[order]].sum(0)
        return np.concatenate([start, (pairs * self.step).ravel(), emit.ravel(), [np.log(scale).sum()]])


def batches_of(seqs: list[np.ndarray], most: int = CELLS):
    """Places of sequences of about the same length, of a bounded number of symbols together."""
    order, at = sorted(range(len(seqs)), key=lambda i: -len(seqs[i])), 0
    while at < len(order):
        end, held = at, 0
        while end < len(order) and (end == at or held + len(seqs[order[end]]) <= most):
            held += len(seqs[order[end]])
            end += 1
        yield order[at:end]
        at = end


def trained(rows: DataFrame, counts: np.ndarray, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over rows' symbols: each task returns the expected counts of its texts, Spark adds them up."""
    spark = rows.sparkSession
    model, symbols, before = Model.first(counts, states), len(counts), -np.inf
    size = states + states * states + states * symbols + 1
    # What a round returns is per task and of fixed size, so no more tasks than the cluster can use.
    own = rows.select("symbols")
    own = own.coalesce(max(1, min(own.rdd.getNumPartitions(), 3 * spark.sparkContext.defaultParallelism)))
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(model)

        def expect(batches, sent=sent):
            now, total = sent.value, np.zeros(size)
            for batch in batches:
                for part in rows_of(batch):
                    whole = [np.frombuffer(x, "<u2").astype(np.int64) for x in part.column(0).to_pylist()]
                    seqs = [s[i : i + PIECE] for s in whole for i in range(0, len(s), PIECE)]
                    first = np.array([i == 0 for s in whole for i in range(0, len(s), PIECE)])
                    for at in batches_of(seqs):
                        total += now.expected([seqs[i] for i in at], first[at])
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"at": pa.array(at.astype(np.int32)), "x": pa.array(total[at])})

        total = np.zeros(size)
        # A row for each state and symbol, whatever the input.
        for r in own.mapInArrow(expect, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).toLocalIterator():
            total[r.at] = r.x
        model = Model.of(total, states, symbols)
        # Emissions add up to the number of tokens.
        likely = total[-1] / max(total[states + states * states : -1].sum(), 1)
        if likely - before < GAIN:
            break
        before = likely
    return model


def language_scores(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    held_out: a function of the id column to a boolean; rows for which it is true aren't learnt from, null counts as false.
    Null and empty texts are the end token alone. Repeated rows are scored each and, if learnt from, counted each; ties among
    the commonest tokens go to the lower key. Without training rows every count is 0. Other columns are ignored.
    """
    own = texts(docs, id_col, text_col)
    own = own.select("doc_id", "text", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"))
    counts = written(token_counts(own.where("not held_out")), "counts")
    common = commonest(counts, KNOWN)  # a fixed number
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    rows = written(encoded(own, common, frequent).withColumn("row", F.monotonically_increasing_id()), "symbols")
    top = common[:frequent]
    rest_n, rest_v = total.n - sum(n for _, n in top), total.v - len(top)
    model = trained(rows.where("not held_out"), np.array([n for _, n in top] + [rest_n], float), states, rounds)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def step(cols):
            seqs = [np.frombuffer(x, "<u2").astype(np.int64) for x in cols.pop("symbols")]
            out = np.zeros(len(seqs))
            for at in batches_of(seqs, 8 * CELLS):
                out[at] = sent.value.scores([seqs[i] for i in at])
            yield cols | {"forward": out / LOG10}

        return step

    passed = rows.select("symbols", "row", "doc_id", "held_out", "n_tokens", "n_known", "n_rest", "log_all", "log_rest")
    forward = map_batches(passed, make, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, n_rest long, log_all double, log_rest double, forward double")
    # The tokens beyond the common ones: a row for each distinct one of a text, so that no key is hot.
    far = rows.select("row", F.explode(F.arrays_zip("keys", "tf")).alias("x")).select("row", "x.keys", "x.tf").withColumnRenamed("keys", "key")
    sums = far.join(counts, "key").groupBy("row").agg(F.sum("tf").alias("far_known"), F.sum(F.col("tf") * F.log10(F.col("n") + 1)).alias("far_log"))
    out = forward.join(sums, "row", "left").na.fill(0, ["far_known", "far_log"])
    base = F.col("log_all") + F.col("far_log") - F.col("n_tokens") * float(np.log10(total.n + total.v + 1))
    rest = F.col("log_rest") + F.col("far_log") - F.col("n_rest") * float(np.log10(rest_n + rest_v + 1))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("far_known")).cast("long").alias("n_known"), F.lit(total.n).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("forward") + rest).alias("score")
    )


def op1_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log10 probability of every document under the model, beside the base of counts; odd rows as in the functions it calls."""
    return language_scores(table(spark, sf_dir, "documents"), lambda i: fold(i, FOLDS) == HELD)
