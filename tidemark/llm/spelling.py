"""Spelling variants: words one code point apart by search schemes on bidirectional FM-indexes of parts of the vocabulary."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import rows_of, table, texts, written

#: Code points and occurrences of a word at least, how much commoner a form is, and every how manyth hash loses a code point.
SHORTEST, LEAST, COMMONER, LOSES = 7, 2, 10, 31
#: Words of an index, about, and queries that go through it together.
BLOCK, ABREAST = 8192, 2048
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_FOUND = pa.schema([("word", pa.string()), ("part", pa.int64()), ("best", pa.int64()), ("other", pa.string())])


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """word, n. A task counts what it meets and sends its counts on when they are many; Spark adds them up."""
    run = re.compile(rf"[A-Za-zÀ-ÿ]{{{shortest},}}")

    def count(batches):
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_pydict({"word": list(held), "n": list(held.values())}, schema=pa.schema([("word", pa.string()), ("n", pa.int64())]))

        for batch in batches:
            for part in rows_of(batch):
                for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    seed = zlib.crc32(f"{'' if i is None else i}:".encode())
                    for w, k in Counter(run.findall((text or "").encode().translate(_LOWER).decode())).items():
                        h = zlib.crc32(w.encode(), seed)
                        if h % LOSES == 0:
                            at = h % len(w)
                            w = w[:at] + w[at + 1 :]
                        if len(w) >= shortest:
                            held[w] += k
                    if len(held) > 100_000:
                        yield out()
                        held.clear()
        yield out()

    return texts(docs).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


class Index:
    """Bidirectional FM-index of sorted distinct words, each between delimiters. Symbols: 0 the end, 1 the delimiter, then the
    code points of `alphabet` in order, so that the suffixes that begin with a delimiter stand in the order of the words."""

    def __init__(self, words: list[str], alphabet: np.ndarray):
        joined = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("utf-32-le"), "<u4")
        code = np.where(joined == 0, 1, np.searchsorted(alphabet, joined) + 2).astype(np.int64)
        self.symbols = len(alphabet) + 2
        self.size = len(code) + 1
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(np.append(code, 0), minlength=self.symbols))]).astype(np.int64)
        #: What precedes the suffixes of the text, and of the reversed text: what follows the prefixes.
        self.left, self.right = self._smaller(code), self._smaller(code[::-1])

    def _smaller(self, code: np.ndarray) -> np.ndarray:
        """For each place of the transformed text and each symbol: how many smaller symbols stand before."""
        t = np.append(code, 0)
        width = int(self.symbols - 1).bit_length()
        step = 60 // width
        ahead = np.concatenate([t, np.zeros(step, np.int64)])
        key = np.zeros(len(t), np.int64)
        for j in range(step):
            key = (key << width) | ahead[j : j + len(t)]
        while True:  # ranks by twice as many symbols each time; the end is unique, so all ranks part
            order = np.argsort(key, kind="stable")
            new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
            if new[-1] == len(t) - 1:
                break
            rank = np.empty(len(t), np.int64)
            rank[order] = new
            key = rank * (len(t) + 1) + np.concatenate([rank[step:] + 1, np.zeros(min(step, len(t)), np.int64)])[: len(t)]
            step *= 2
        before = t[order - 1]
        seen = np.zeros((len(t) + 1, self.symbols + 1), np.int32)
        seen[np.arange(1, len(t) + 1), before + 1] = 1
        np.cumsum(seen, axis=0, out=seen)
        np.cumsum(seen, axis=1, out=seen)
        return seen

    def near(self, seen: np.ndarray, pattern: np.ndarray, length: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, and suffix rank in either direction, of every way to match a pattern with exactly one error behind its first
        `exact` symbols. Patterns include both delimiters. Extension by a symbol takes two counts at either end of an interval."""
        a, b, size = (np.full(len(pattern), x, np.int64) for x in (0, 0, self.size))
        live, made = np.arange(len(pattern)), []
        for at in range(int(length.max(initial=0))):
            keep = (size > 0) & (at < length[live])
            live, a, b, size = live[keep], a[keep], b[keep], size[keep]
            if not len(live):
                break
            c = pattern[live, at]
            low = seen[a]
            below = seen[a + size] - low
            own = np.arange(len(live))
            wide = np.flatnonzero(at >= exact[live])
            if len(wide):
                # Another symbol in place of this one, or before it; or this one left out. In a run of one symbol, what is one more
                # or one less of it is found at the end of the run, so repeats don't multiply.
                i, s = np.nonzero(np.diff(below[wide], axis=1)[:, 2:])
                i, s = wide[i], s + 2
                child = (live[i], self.starts[s] + low[i, s + 1] - low[i, s], b[i] + below[i, s], below[i, s + 1] - below[i, s])
                other = s != c[i]
                swap = other & (c[i] > 1)
                made.append((*(x[swap] for x in child), np.full(int(swap.sum()), at + 1)))
                made.append((*(x[other] for x in child), np.full(int(other.sum()), at)))
                out = wide[(c[wide] > 1) & (c[wide] != pattern[live[wide], np.minimum(at + 1, pattern.shape[1] - 1)])]
                made.append((live[out], a[out], b[out], size[out], np.full(len(out), at + 1)))
            a, b, size = self.starts[c] + low[own, c + 1] - low[own, c], b + below[own, c], below[own, c + 1] - below[own, c]
        if not made:
            return (np.zeros(0, np.int64),) * 3
        q, a, b, size, at = (np.concatenate(x) for x in zip(*made, strict=True))
        done = []
        while len(q):
            c = pattern[q, at]
            low, low1, high, high1 = seen[a, c], seen[a, c + 1], seen[a + size, c], seen[a + size, c + 1]
            a, b, size, at = self.starts[c] + low1 - low, b + high - low, (high1 - high) - (low1 - low), at + 1
            keep = size > 0
            over = keep & (at == length[q])
            done.append((q[over], a[over], b[over]))
            keep &= ~over
            q, a, b, size, at = q[keep], a[keep], b[keep], size[keep], at[keep]
        return tuple(np.concatenate(x) for x in zip(*done, strict=True))


def matched(words: list[str], counts: np.ndarray, ask: list[str], sides: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query: number of near words among `words`, and the commonest one's count and place (-1: none). Side 0 matches a
    query's first half and lets the error fall behind it; side 1 matches the second half, and leaves out what side 0 finds."""
    order = sorted(range(len(words)), key=words.__getitem__)
    words, counts = [words[i] for i in order], counts[order]
    alphabet = np.unique(np.frombuffer("".join({*"".join(words), *"".join(ask)}).encode("utf-32-le"), "<u4"))
    index = Index(words, alphabet)

    size = np.array(list(map(len, ask)))
    n, best, place = np.zeros(len(ask), np.int64), np.zeros(len(ask), np.int64), np.full(len(ask), -1)
    for side in (0, 1):
        every = np.flatnonzero(sides == side)
        every = every[np.argsort(size[every], kind="stable")]
        start = 0
        while start < len(every):
            # Patterns of like length go abreast, fewer of them where they are long.
            width = int(size[every[min(start + ABREAST, len(every)) - 1]]) + 2
            at = every[start : start + max(1, min(ABREAST, (1 << 20) // width))]
            start += len(at)
            long, half = size[at], size[at] // 2
            width = int(long.max()) + 2
            text = [f"\0{ask[i][::-1] if side else ask[i]}".ljust(width, "\0") for i in at.tolist()]
            pattern = np.frombuffer("".join(text).encode("utf-32-le"), "<u4").reshape(len(at), width)
            pattern = np.where(pattern == 0, 1, np.searchsorted(alphabet, pattern) + 2)
            q, a, b = index.near(index.left if side else index.right, pattern, long + 2, 1 + (long - half if side else half))
            # The first suffix that begins with a delimiter is the last delimiter's; the others stand in the order of the words.
            found = np.unique(q * len(words) + (a if side else b) - 2)
            q, u = found // len(words), found % len(words)
            if side:
                keep = np.array([not words[y].startswith(ask[at[x]][: half[x]]) for x, y in zip(q.tolist(), u.tolist(), strict=True)], bool)
                q, u = q[keep], u[keep]
            np.add.at(n, at[q], 1)
            # The largest count comes first within a query, then the first word.
            rank = np.lexsort((u, -counts[u], q))
            q, u = q[rank], u[rank]
            lead = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else np.zeros(0, int)
            best[at[q[lead]]], place[at[q[lead]]] = counts[u[lead]], u[lead]
    return n, best, np.where(place >= 0, np.array(order)[place], -1)


def halves(word: Column, own: bool) -> Column:
    """Keys of a word: side and half. Own ones are what a query matches exactly; with the others, those by which a word is found by
    queries one shorter or one longer."""
    size = F.length(word)
    about = [size] if own else [size - 1, size, size + 1]
    first = F.array_distinct(F.array(*(F.floor(x / 2).cast("int") for x in about)))
    second = F.array_distinct(F.array(*(F.ceil(x / 2).cast("int") for x in about)))
    key = lambda side, text: F.struct(F.lit(side).alias("side"), text.alias("half"))
    return F.concat(F.transform(first, lambda k: key(0, F.substring(word, F.lit(1), k))), F.transform(second, lambda k: key(1, F.substring(word, size - k + 1, k))))


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n_near, best (the count of the commonest near word) and other (that word) of words that have near ones.

    A near word shares the first half of a word or the second, so a word is indexed under its halves and asks under its own: only words
    that share a half meet. Halves are packed into indexes of about `block` words. A half with more words has indexes of its own, words
    dealt over them by hash, and each of its queries goes through all of them. Lists of near words never leave a task."""
    key = F.struct("key.side", "key.half")
    keyed = words.select("word", "n", F.explode(halves(F.col("word"), own=False)).alias("key"), F.lit(False).alias("ask"))
    asked = words.select("word", "n", F.explode(halves(F.col("word"), own=True)).alias("key"), F.lit(True).alias("ask"))
    held = keyed.groupBy(key.alias("key")).agg(F.count("*").alias("size"))
    packs = max(1, 4 * words.count() // block)
    large = held.where(F.col("size") > block).select("key", F.ceil(F.col("size") / block).alias("blocks"))
    both = keyed.unionByName(asked).join(large, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = F.when(F.col("blocks") == 1, F.array(F.lit(0).cast("long"))).when(F.col("ask"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array(F.pmod(F.xxhash64("word"), F.col("blocks"))))
    small = F.concat(F.lit("s"), F.pmod(F.xxhash64("key"), F.lit(packs)))
    pack = F.when(F.col("blocks") == 1, small).otherwise(F.concat_ws("/", "key.side", "key.half", "b"))
    spread = both.withColumn("b", F.explode(dealt)).select(pack.alias("pack"), F.col("key.side").alias("side"), "word", "n", "ask")

    def run(own):
        word, n, side = (own.column(c).to_pylist() for c in ("word", "n", "side"))
        ask = np.array(own.column("ask").to_pylist(), bool)
        count = {w: k for w, k, a in zip(word, n, ask.tolist(), strict=True) if not a}
        at = np.flatnonzero(ask).tolist()
        if not count or not at:
            return pa.Table.from_pylist([], schema=_FOUND)
        there, asks = list(count), [word[i] for i in at]
        near, best, place = matched(there, np.array(list(count.values()), np.int64), asks, np.array([side[i] for i in at]))
        hit = np.flatnonzero(near).tolist()
        return pa.Table.from_pydict({"word": [asks[i] for i in hit], "part": near[hit], "best": best[hit], "other": [there[place[i]] for i in hit]}, schema=_FOUND)

    # Little data and much work: more tasks than sizes alone would make.
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = spread.repartition(max(tasks, min(packs // 4, 1 << 14)), "pack").groupBy("pack").applyInArrow(run, "word string, part long, best long, other string")
    first = F.min(F.struct((-F.col("best")).alias("k"), F.col("other").alias("other")))
    return found.groupBy("word").agg(F.sum("part").alias("n_near"), first.alias("first")).select("word", "n_near", (-F.col("first.k")).alias("best"), "first.other")


def roots(formed: DataFrame) -> DataFrame:
    """word, root for words with a form. A form is ten times as common as its word, so chains are short and every round halves what
    is left of them."""
    own = written(formed.select("word", F.col("form").alias("root")), "roots")
    while True:
        then = own.join(own.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
        then = written(then.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if then.where("moved").isEmpty():
            return then.select("word", "root")
        own = then.select("word", "root")


def variants(docs: DataFrame, commoner: int = COMMONER, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the texts.

    A null text has no words; a null id is hashed as an empty one. Repeated rows count as often as they stand there. Without words
    there are no rows. Only A-Z are lower-cased, so É and é stay two letters. An index holds its words whole, some 300 bytes a code point:
    a word of a million letters takes 300 MB of the task that has it."""
    words = written(vocabulary(docs), "words")
    near = near_words(words, block)
    has = F.col("best") >= commoner * F.col("n")
    own = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("other")).alias("form"), F.when(has, F.col("best")).alias("form_n"))
    own = written(own, "near")
    out = own.join(roots(own.where("form is not null")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, forms and roots; see variants() for odd rows."""
    return variants(table(spark, sf_dir, "documents"))
