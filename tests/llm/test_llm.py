"""The ten operators against brute force, and their edge cases."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import public_tokenizers

import __spark_entry__ as entry
from tidemark.llm import byte_bpe, chunks, decontaminate, embeddings, hmm, jaccard, lines, pages, quality, unigram
from tidemark.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, hits int, score double"
ODD = [(1, None, "en", 1, 0.5), (2, "", "en", 1, 0.5), (3, " \n ", None, 1, None), (None, "a b c d", "en", 1, 0.5), (4, "x" * 5000, "en", 2, 0.1), (5, "a b c d e", "en", 1, 0.5), (5, "a b c d e", "en", 1, 0.5), (6, "日本 語 🙂 İ ß", "ja", 3, 0.2)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.mark.parametrize("name", [k for k in entry.oracle_sql() if k.startswith("op")])
def test_oracle(spark, sf_dir, name):
    from tests.test_oracles import TABLES, rows

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    out, want = entry.queries()[name](spark, sf_dir), con.sql(entry.oracle_sql()[name])
    assert rows(out.columns, [tuple(r) for r in out.collect()]) == rows(list(want.columns), want.fetchall())


def test_bpe_is_the_librarys(docs, texts, odd):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(byte_bpe.RANKS), "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in byte_bpe.encode(docs).collect():
        assert r.ids == own.encode_ordinary(texts[r.doc_id])
    got = byte_bpe.encode(odd)
    assert Counter(r.decoded_sha256 for r in got.collect()) == Counter(hashlib.sha256((x[1] or "").encode()).hexdigest() for x in ODD)
    assert Counter(r.text for r in byte_bpe.decode(got).collect()) == Counter(x[1] or "" for x in ODD)


def test_long_matches_merge_alike():
    bpe = byte_bpe.pairs_of(byte_bpe.rank_blob(public_tokenizers.path(byte_bpe.RANKS)))
    piece = ("abcabd" * 60).encode()
    out = [b""]
    bpe._matrix([piece], [0], out)
    assert out[0] == bpe._long(piece) and bpe.decode(out[0]) == piece


def test_decontamination(spark, odd):
    items = spark.createDataFrame([(7, "one two three four five six seven eight nine ten eleven"), (8, "b C, d"), (9, ""), (10, None)], "item_id long, text string")
    rows = spark.createDataFrame([(1, "x One two, three four five six seven eight nine TEN y"), (2, "a b c d"), (3, None), (4, "one two three")], "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(rows, items).collect()}
    assert got[1].hits == [[1, 11]] and got[1]["items"] == [7]
    assert got[2].hits == [[1, 4]] and got[2]["items"] == [8] and got[4].hits == [] and got[3].n_words == 0
    several = {r.doc_id: (r.hits, r["items"]) for r in decontaminate.contamination(rows, items, item_words=3).collect()}
    assert several == {k: (r.hits, r["items"]) for k, r in got.items()}
    kept = {r.doc_id: r.text for r in decontaminate.decontaminate(rows, items, max_coverage=0.9).collect()}
    assert kept == {r.doc_id: r.text for r in decontaminate.decontaminate(rows, items, max_coverage=0.9, item_words=1, carry=True).collect()}
    assert kept == {1: "x y", 2: "a", 3: None, 4: "one two three"}
    assert decontaminate.contamination(odd, items).count() == len(ODD)
    assert decontaminate.contamination(rows, items.limit(0)).where("size(hits) > 0").count() == 0


@pytest.mark.parametrize("window", [2, 3, 5])
def test_automaton_against_brute_force(window):
    rng = np.random.default_rng(window)
    for _ in range(150):
        alphabet = [b"a", b"b", b"c", b"d"][: rng.integers(2, 5)]
        word = lambda: alphabet[rng.integers(len(alphabet))]
        items = [(k, [word() for _ in range(rng.integers(1, 12))]) for k in range(rng.integers(1, 8))]
        text = [word() if rng.random() < 0.9 else b"z" for _ in range(60)]
        want, found = set(), set()
        for item, own in items:
            m = min(window, len(own))
            for i in range(len(own) - m + 1):
                for at in range(len(text) - m + 1):
                    if text[at : at + m] == own[i : i + m]:
                        want.update(range(at, at + m))
                        found.add(item)
        spans, got = decontaminate.Automaton(items, window).hits(text)
        assert got == found and {k for a, b in spans for k in range(a, b)} == want


def test_decontamination_edges(spark, odd):
    items = spark.createDataFrame([(7, "a b c")], "item_id long, text string")
    assert decontaminate.contamination(odd.limit(0), items).collect() == [] and decontaminate.decontaminate(odd.limit(0), items, item_words=1).collect() == []
    long = "w " * 400_000 + "a b c"
    one = decontaminate.contamination(spark.createDataFrame([(1, long)], "doc_id long, text string"), items).first()
    assert (one.n_words, one.hits, one["items"]) == (400_003, [[400_000, 400_003]], [7])
    # An item longer than a run is cut into pieces, which lose none of its windows and take no more than a run's words.
    rng = np.random.default_rng(3)
    words = lambda n: " ".join(rng.choice(list("abcdefgh"), n))
    item = words(90)
    items = spark.createDataFrame([(7, item), (8, words(9)), (9, words(25))], "item_id long, text string")
    rows = [(k, f"{words(5)} {' '.join(item.split()[k : k + 12])} {words(5)}") for k in range(0, 80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((r.doc_id, r.hits, r["items"]) for r in decontaminate.contamination(docs, items).collect())
    assert all(7 in x[2] for x in want)
    runs = list(decontaminate.runs_of(items, "item_id", "text", 40))
    assert len(runs) > 3 and max(sum(len(w) for _, w in run) for run in runs) <= 40
    assert sorted((r.doc_id, r.hits, r["items"]) for r in decontaminate.contamination(docs, items, item_words=40).collect()) == want


def test_quality_on_held_out_rows(spark, sf_dir):
    sf = sf_dir.replace("sf0.001", "sf0.01")
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = [r for r in entry.queries()["op2_quality"](spark, sf).collect() if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert np.mean([r.predicted == truth[r.doc_id] for r in out]) >= 0.95


def test_ftrl_against_one_coordinate_at_a_time():
    rng = np.random.default_rng(1)
    model = quality.Ftrl(bits=4)
    z, n = [0.0] * 17, [0.0] * 17
    weight = lambda i: 0.0 if abs(z[i]) <= model.l1 else -(z[i] - math.copysign(model.l1, z[i])) / ((model.beta + math.sqrt(n[i])) / model.alpha + model.l2)
    for _ in range(200):
        grams, label = [rng.integers(0, 16, rng.integers(1, 9)) for _ in range(rng.integers(0, 4))], int(rng.integers(2))
        x = {16: 1.0}
        for g in grams:
            for i in g.tolist():
                x[i] = x.get(i, 0.0) + model.scale / len(g)
        p = 1 / (1 + math.exp(-sum(weight(i) * v for i, v in x.items())))
        for i, v in x.items():
            g, w = (p - label) * v, weight(i)
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / model.alpha * w
            n[i] += g * g
        model.learn(grams, label)
        assert np.allclose(model.z, z) and np.allclose(model.n, n) and np.allclose(model.weights(), [weight(i) for i in range(17)])


def test_an_id_is_learnt_from_once(spark):
    rows = [(k, "good words here" if k % 2 else "bad things there") for k in range(1, 60)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 60)] + [(3, 0)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    more = spark.createDataFrame(rows + [(2, "bad things there")] * 300, "doc_id long, text string").repartition(5)
    assert np.array_equal(quality.train(docs, labels), quality.train(more, labels))
    assert quality.scored(docs.limit(0), np.zeros((1 << quality.DIM_BITS) + 1)).collect() == []


def test_quality_edges(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = quality.scored(odd, quality.train(odd, none), score_col="p").collect()
    assert len(out) == len(ODD) and all(r.p == 0.5 for r in out)
    with pytest.raises(ValueError):
        quality.scored(odd, np.zeros(5))


def test_forward_scores_are_exact():
    rng = np.random.default_rng(0)
    model = hmm.Model.first(rng.integers(1, 9, 5).astype(float), 3)
    for seq in ([0], [1, 4, 2, 2], [3, 0, 1]):
        total = 0.0
        for path in np.ndindex(*[3] * len(seq)):
            p = model.start[path[0]] * model.emit[path[0], seq[0]]
            for t in range(1, len(seq)):
                p *= model.step[path[t - 1], path[t]] * model.emit[path[t], seq[t]]
            total += p
        got = model.scores([np.array(seq), np.array([1, 1])])[0]
        assert math.isclose(got, math.log(total), rel_tol=1e-12)


def test_expected_counts_against_every_path():
    rng = np.random.default_rng(4)
    model = hmm.Model.first(rng.integers(1, 9, 4).astype(float), 2)
    seqs, first = [np.array([0, 3, 1]), np.array([2]), np.array([1, 1, 2, 0])], np.array([True, True, False])
    start, step, emit, likely = np.zeros(2), np.zeros((2, 2)), np.zeros((2, 4)), 0.0
    for seq, begins in zip(seqs, first, strict=True):
        paths = {}
        for path in np.ndindex(*[2] * len(seq)):
            p = model.start[path[0]] * model.emit[path[0], seq[0]]
            for t in range(1, len(seq)):
                p *= model.step[path[t - 1], path[t]] * model.emit[path[t], seq[t]]
            paths[path] = p
        total = sum(paths.values())
        likely += math.log(total)
        for path, p in paths.items():
            start[path[0]] += p / total * begins
            for t, s in enumerate(path):
                emit[s, seq[t]] += p / total
                if t:
                    step[path[t - 1], s] += p / total
    assert np.allclose(model.expected(seqs, first), np.concatenate([start, step.ravel(), emit.ravel(), [likely]]), rtol=1e-10)


def test_commonest_tokens(spark):
    rng = np.random.default_rng(8)
    n = np.unique(rng.pareto(0.6, 4000).astype(np.int64) % (1 << 40) + 1, return_counts=False)
    rows = [(int(k), int(x)) for k, x in enumerate([*n, *n[:200], *[1] * 50])]
    df = spark.createDataFrame(rows, "key long, n long")
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    for most in (0, 1, 100, len(rows) - 1, len(rows)):
        got = hmm.commonest(df, most)
        assert len(got) <= most and got == order[: len(got)]
    assert hmm.commonest(df, len(rows)) == order and len(hmm.commonest(df, 300)) > 200 and hmm.commonest(df.limit(0), 5) == []


def test_training_raises_the_likelihood():
    rng = np.random.default_rng(2)
    seqs = [np.tile([0, 1, 2], rng.integers(2, 9)) for _ in range(30)]
    model = hmm.Model.first(np.ones(3), 3)
    scores = [model.scores(seqs).sum()]
    for _ in range(6):
        model = hmm.Model.of(model.expected(seqs, np.ones(len(seqs), bool)), 3, 3)
        scores.append(model.scores(seqs).sum())
    assert all(b > a - 0.5 for a, b in zip(scores, scores[1:])) and scores[-1] > scores[0] + 10


def test_base_score(spark, docs, texts, sf_dir, odd):
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 7 == 2}
    tokens = {i: [w for w in re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower())] + [hmm.END] for i, t in texts.items()}
    c = Counter(w for i, ws in tokens.items() if i not in held for w in ws)
    n, v = sum(c.values()), len(c)
    out = hmm.language_scores(docs, lambda i: hmm.fold(i, 7) == 2, frequent=50, rounds=1).collect()
    assert len(out) == len(texts)
    for r in out:
        want = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens[r.doc_id])
        assert math.isclose(r.base_score, want, rel_tol=1e-9) and r.train_tokens == n and r.held_out == (r.doc_id in held)
        assert r.n_tokens == len(tokens[r.doc_id]) and r.n_known == sum(w in c for w in tokens[r.doc_id]) and r.score < 0
    assert hmm.language_scores(odd, lambda i: hmm.fold(i, 7) == 2, rounds=1).count() == len(ODD)


def test_hmm_beats_the_base(spark, sf_dir):
    out = [r for r in entry.queries()["op1_hmm_score"](spark, sf_dir).collect() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_trie_counts(texts, odd):
    pieces = unigram.pieces_of(open(public_tokenizers.path(unigram.PIECES), "rb").read())
    words = sorted({unigram.SPACE + w for t in list(texts.values())[:20] for w in t.split()} | {"▁日本語🙂", "▁"})

    def brute(word):
        best = [(0.0, 0)] + [(-math.inf, 0)] * len(word)
        for e in range(1, len(word) + 1):
            k = len(word[e - 1].encode())
            options = [(best[e - 1][0] + unigram.BYTE_SCORE * k, -(-best[e - 1][1] + k))]
            options += [(best[s][0] + pieces[word[s:e]], best[s][1] - 1) for s in range(e) if word[s:e] in pieces]
            best[e] = max(options)
        return -best[-1][1]

    assert unigram.terminal_counts(words, pieces, max(map(len, pieces))) == [brute(w) for w in words]
    assert {r.n_tokens for r in unigram.token_counts(odd).where("doc_id in (1, 2, 3)").collect()} == {0}


def test_chunks_resist_shifts(spark, odd):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), 6))
    make = lambda n: " ".join(word() for _ in range(n))
    passage = make(60)
    rows = [(1, make(80) + " " + passage + " " + make(40)), (2, "zz " + passage + " " + make(90)), (3, make(200)), (4, make(150) + " q " + passage), (5, None), (None, passage)]
    spans = chunks.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.src_doc_id) for r in spans} == {(2, 1), (4, 1)}
    for r in spans:
        assert rows[r.doc_id - 1][1].encode()[r.start : r.start + r.n_bytes].decode() in passage + " "
    data = rows[0][1].encode()
    h = 0
    for k, b in enumerate(data):
        h = ((h << 1) + int(chunks._GEAR[b])) & 0xFFFFFFFF
        assert h == int(chunks.gear(np.frombuffer(data, np.uint8))[k]) if k < 200 else True
    left = chunks.without_spans(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(spans)).where("doc_id = 3").first()
    assert left.text == rows[2][1]
    assert chunks.repeated_spans(odd).count() == 0


def test_insertions_change_only_the_chunks_around_them():
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(1, 9))) for _ in range(5000)]
    digests = lambda w: set(zip(*(x.tolist() for x in chunks.chunk_rows(chunks.Words(" ".join(w), chunks.Powers()), None)[:2]), strict=True))
    own = digests(words)
    assert len(own) > 150
    for at in (0, 1234, 2500, 5000):
        moved = digests([*words[:at], "inserted", "é", *words[at:]])
        assert len(own - moved) <= 6 and len(moved - own) <= 8
    a, b, _ = chunks.Words(" ".join(words), chunks.Powers()).chunks()
    assert (b - a).max() <= 2 * chunks.WORDS and (b[:-1] - a[1:] == chunks.WORDS - 1).all() and a[0] == 0 and b[-1] == 5000
    assert len(chunks.Words("a " * 100_000, chunks.Powers()).chunks()[0]) == 1  # a text that repeats itself


def test_rows_of_one_id_have_spans_of_their_own(spark):
    rng = np.random.default_rng(12)
    make = lambda n: " ".join("".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(n))
    one, two, own = make(60), make(70), [make(40) for _ in range(4)]
    rows = [(1, f"{own[0]} {one} {own[1]} {two}"), (5, f"{one} {own[2]}"), (5, f"{own[3]} {two}"), (5, f"{own[3]} {two}"), (6, f"é{one}é"), (7, one[:30] + "é" + one[31:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spans = chunks.repeated_spans(docs)
    assert sorted((r.doc_id, r.src_doc_id, r.n_words) for r in spans.collect()) == [(5, 1, 60), (5, 1, 70), (6, 1, 58), (7, 1, 55)]
    left = sorted(r.text for r in chunks.without_spans(docs, spans).where("doc_id = 5").collect())
    assert left == sorted([f" {own[2]}", f"{own[3]} ", f"{own[3]} "])
    assert chunks.repeated_spans(docs.limit(0)).collect() == [] and chunks.without_spans(docs.limit(0), spans).collect() == []


def brute_windows(rows, n):
    """Words, by id, that are part of n words which a text with a lower id holds byte for byte."""
    seen, out = {}, {}
    for i, text in sorted((r for r in rows if r[0] is not None and r[1]), key=lambda r: r[0]):
        data = text.encode()
        at = [m.span() for m in re.finditer(rb"[^ \t-\r]+", data)]
        for k in range(len(at) - n + 1):
            if seen.setdefault(data[at[k][0] : at[k + n - 1][1]], i) < i:
                out.setdefault(i, set()).update(at[k : k + n])
    return out


def covered(spans, rows):
    text = {i: t.encode() for i, t in rows if i is not None and t}
    out = {}
    for r in spans:
        found = [(r.start + a, r.start + b) for a, b in (m.span() for m in re.finditer(rb"[^ \t-\r]+", text[r.doc_id][r.start : r.start + r.n_bytes]))]
        assert len(found) == r.n_words >= chunks.WORDS and r.src_doc_id < r.doc_id
        out.setdefault(r.doc_id, set()).update(found)
    return out


def test_every_repeated_passage_is_found(spark, sf_dir):
    rng = np.random.default_rng(6)
    make = lambda n: " ".join("".join(rng.choice(list("abcdefghijklmnop"), rng.integers(1, 9))) for _ in range(n))
    rows = []
    for k in range(200):  # passages of 49 to 60 words between other contexts, which chunks cut at other places
        passage = make(49 + k % 12)
        rows += [(2 * k, f"{make(k % 30)} {passage}\n{make(20)}"), (2 * k + 1, f"{make(20)} {passage} {make(k % 30)}")]
    # Part of the passage is also in a still earlier text; periodic texts, shifted.
    rows += [(-1, make(20) + " " + " ".join(rows[14][1].split()[10:45])), (900, "a b c " * 60), (901, "z " + "b c a " * 40 + make(70)), (902, make(60) + " c" + " a b c" * 30)]
    # Longest first: the earlier copies of a line stand in texts that share less.
    both = make(80).split()
    rows += [(910, make(9) + " " + " ".join(both[:55])), (911, " ".join(both[5:])), (912, " ".join(both) + " " + make(9)), (913, " ".join(both[:40]) + "\t" + " ".join(both[40:]))]
    # A text that holds an earlier passage twice, in one and the same context.
    for k in range(920, 940, 2):
        passage, around = make(52), make(60)
        rows += [(k, f"{make(9)} {passage} {make(9)}"), (k + 1, f"{around} {passage} {around} {passage} {around}")]
    got = chunks.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert covered(got, rows) == brute_windows(rows, chunks.WORDS)
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert covered(chunks.repeated_spans(docs).collect(), rows) == brute_windows(rows, chunks.WORDS)


def test_line_runs(spark, odd):
    rows = [(1, "a\nb\nc\nd"), (2, "x\nb\n\nc \nd\ny"), (3, "a\nq\nb"), (4, None), (5, "")]
    out = {r.doc_id: (r.text, r.n_removed) for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: ("a\nb\nc\nd", 0), 2: ("x\n\ny", 3), 3: ("a\nq\nb", 0), 4: (None, 0), 5: ("", 0)}
    assert lines.dedup_lines(odd, carry=True).count() == len(ODD)


def test_lines_of_long_and_of_repeated_texts(spark):
    text = "\n".join(f"line {k}" for k in range(30_000))
    rows = [(1, text), (2, text + "\nend"), *[(3, "line 7\nline 8\nline 9\nz")] * 50]
    began = __import__("time").time()
    out = {(r.doc_id, r.text, r.n_lines, r.n_removed) for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), contexts=True).collect()}
    assert out == {(1, text, 30_000, 0), (2, "end", 30_001, 30_000), (3, "z", 4, 3)} and __import__("time").time() - began < 60
    assert lines.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_long_lines_go_alone(spark):
    import corpus_pipeline

    long, short = " ".join(f"w{k}" for k in range(51)), " ".join(f"v{k}" for k in range(50))
    rows = [(1, f"a\n{long}\nb"), (2, f"c\n{long} \nd"), (3, long), (4, f"{short}\ne\n"), (5, short), (6, f"{long}x\nf\n{long}x"), (None, long)]
    out = {r.doc_id: r.text for r in corpus_pipeline.drop_lines(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()}
    assert out == {k: v for k, v in (dict(rows) | {2: "c\nd", 6: f"{long}x\nf"}).items() if k != 3}


def test_every_run_of_three_lines_goes(spark, sf_dir):
    rows = [(10 * k + i, "\n".join(f"{x}{k}" for x in own)) for k in range(20) for i, own in enumerate(["XBCY", "ABCD", "ABCD"])]
    docs = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/documents.parquet").select("doc_id", "text").collect()
    rows += [(1000 + r.doc_id, r.text) for r in docs]
    seen, want = {}, {}
    for i, text in sorted(rows):
        own = [(k, x) for k, x in enumerate(x.strip(" \t\r") for x in (text or "").split("\n")) if x]
        for at in range(len(own) - 2):
            if seen.setdefault(tuple(x for _, x in own[at : at + 3]), i) < i:
                want.setdefault(i, set()).update(k for k, _ in own[at : at + 3])
    got = {}
    for r in lines.repeated_runs(spark.createDataFrame(rows, "doc_id long, text string"), contexts=True).collect():
        got.setdefault(r.doc_id, set()).update(r.gone)
    assert len(want) > 20 and not {i: ks - got.get(i, set()) for i, ks in want.items() if ks - got.get(i, set())}


def test_jaccard_edges(spark, odd):
    out = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_documents(odd).collect()}
    assert out == {(1, 0, 1), (2, 0, 2), (3, 0, 3), (None, 1, None), (4, 1, 4), (5, 2, 5), (6, 2, 6)}


def near_rows(size, most):
    """60 texts of `size` words, each with fewer than `most` of them changed."""
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(size)]
    rows = []
    for i in range(60):
        words = list(base)
        for at in rng.integers(0, size, rng.integers(0, most)):
            words[at] = f"e{i}{at}"
        rows.append((i, " ".join(words)))
    return rows


def brute_components(rows, n, link):
    sets = [set(tuple(t.split()[k : k + n]) for k in range(len(t.split()) - n + 1)) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= link * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in range(len(rows))}


@pytest.mark.parametrize("link", [80, 85])
def test_linked_sets_share_a_key(link):
    rng = np.random.default_rng(5)
    for size in [*range(1, 30), 60, 150, 400]:
        for _ in range(20):
            one = np.unique(rng.integers(1, 1 << 63, size, dtype=np.int64).astype(np.uint64))
            two = one
            while True:  # as far apart as a link allows
                then = np.delete(two, rng.integers(len(two))) if rng.random() < 0.5 and len(two) > 1 else np.append(two, np.uint64(rng.integers(1, 1 << 63)))
                both = len(np.intersect1d(one, then))
                if 100 * both < link * (len(one) + len(then) - both):
                    break
                two = then
            two, classes = np.unique(two), jaccard.Classes(link)
            (keys, outline), (others, other) = jaccard.keys(one, classes), jaccard.keys(two, classes)
            assert len(np.intersect1d(keys, others))
            low = min(classes.at(len(one)), classes.at(len(two)))
            lines = [jaccard.outline_in(classes, o, len(x), low) for o, x in ((outline, one), (other, two))]
            assert jaccard.outlines_allow(link, lines[0], len(one), lines[1][None], np.array([len(two)]))[0]


def test_jaccard_small_blocks(spark):
    rows = near_rows(120, 4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (7, 128):
        assert {r.doc_id: r.component_id for r in jaccard.near_documents(df, block=block).collect()} == brute_components(rows, 4, 85)


def test_jaccard_links_that_only_pairs_of_later_nodes_have(spark):
    """Texts that share keys with a hub which they don't link with, and chains of links; a common passage in all of them."""
    rng = np.random.default_rng(9)
    rows, common = [], [f"c{k}" for k in range(30)]
    for g in range(12):
        base = [f"g{g}w{k}" for k in range(90)]
        for step in range(8):  # each next to its neighbour, the ends far apart
            words = list(base)
            for at in range(step):
                words[at * 7 + 3] = f"g{g}s{at}"
            rows.append((int(rng.integers(1 << 40)), " ".join(words[:45] + common + words[45:])))
    order = sorted(rows)
    want = brute_components(list(enumerate(t for _, t in order)), 4, 85)
    for parts in (1, 4):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = {r.doc_id: r.component_id for r in jaccard.near_documents(df, block=5).collect()}
        assert got == {order[i][0]: order[low][0] for i, low in want.items()}


def test_keys_meet_in_a_task_and_across_tasks(spark):
    rng = np.random.default_rng(4)
    have = {i: set(rng.integers(0, 1 << 62, 5).tolist()) | {7} | ({11, 12} if i % 3 else set()) for i in range(50)}
    units = spark.createDataFrame([(i, bytearray(np.array(sorted(k), np.uint64).tobytes())) for i, k in have.items()], "node long, keys binary").repartition(3)
    for buckets in (1, 5):
        got = {}
        for r in jaccard.shared_keys(units, buckets).collect():
            got.setdefault(r.key, set()).update((r.node, r.low))
        assert sorted(map(sorted, got.values())) == sorted([sorted(i for i in have if i % 3)] * 2 + [sorted(have)])


def test_jaccard_empty_table(spark):
    assert jaccard.near_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("most", [2, 3, 6])
def test_near_stage_takes_five_words_and_80_per_cent(spark, most):
    import corpus_pipeline

    # One changed word of 50 leaves a similarity of 41 in 51 or more, which 4 words and 85 per cent would not link.
    rows = near_rows(50, most)
    df = spark.createDataFrame([*rows, (None, rows[0][1]), (60, None), (61, "")], "doc_id long, text string")
    want = {i for i, low in brute_components(rows, 5, 80).items() if i == low} | {None, 60, 61}
    out = corpus_pipeline.drop_near(spark, df, "")
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == want


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, 50), (100, 60), (60, 55), (7, 7)] + [(200, x) for x in range(201, 230)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 1 for k in range(1, 41)} | {50: 50, 100: 50, 60: 50, 55: 50} | {k: 200 for k in range(200, 230)}


def union_find(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def small_graphs(n):
    """Random trees and chains of 5 to 12 nodes, some with more edges."""
    rng = np.random.default_rng(11)
    for k in range(n):
        name = rng.permutation(size := int(rng.integers(5, 13))).tolist()
        edges = [(name[i], name[i - 1 if k % 2 else int(rng.integers(i))]) for i in range(1, size)]
        yield edges + [(a, b) for a, b in rng.integers(0, size, (k % 4 // 2, 2)).tolist() if a != b]


def test_components_of_small_graphs(spark):
    # The first three end a round with a node under two roots and no parent under a parent.
    alone = [[(3, 1), (4, 3), (5, 4), (5, 2)], [(4, 1), (3, 4), (3, 5), (5, 2)], [(3, 2), (4, 3), (5, 4), (1, 5)]]
    for edges in alone:
        got = [tuple(r) for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()]
        assert sorted(got) == sorted(union_find(edges).items())
    # Thousands at once, each in its own range of ids.
    edges = [(100 * k + a, 100 * k + b) for k, graph in enumerate(small_graphs(4000)) for a, b in graph]
    got = [tuple(r) for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()]
    assert sorted(got) == sorted(union_find(edges).items())


def test_vectors(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0], 3), (2, [1.0, 0.0], 3), (3, [0.999, 0.01], 3), (4, [1.0, 0.0], 4), (5, [0.0, 0.0], 3), (6, None, 3), (7, [nan, 1.0], 3), (8, [1.0, 0.0], None), (9, [-1.0, 0.0], 3), (10, [], 3), (11, [None, 1.0], 3), (12, [1.0, 0.0, 0.0], 3)]
    out = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert out == {i: (0, i, True) for i in range(1, 13)} | {1: (2, 1, True), 2: (2, 1, False), 3: (2, 1, False)}
    assert embeddings.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>, label int")).count() == 0


def test_pages(spark):
    shell = "<body><div><a href=x>Home</a> of the site</div><div class=x>{}</div><p>All the news</p></body>"
    rows = [(i, f"http://h/{i}", shell.format(f"<p>own text {i} &amp; more</p>")) for i in range(12)]
    rows += [(20, None, None), (21, "http://g", ""), (22, "http://f", "<article><h1>T</h1>a<br>b<aside>no</aside><p>c&lt;</p><div class='comments'>bad</div></article><footer>f</footer>")]
    out = {r.page_id: r.text for r in pages.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out == {i: f"own text {i} & more" for i in range(12)} | {20: "", 21: "", 22: "T\na b\nc<"}


PAGE = "page_id long, url string, html string"


def extracted(spark, rows, schema=PAGE):
    return {r.page_id: r.text for r in pages.main_texts(spark.createDataFrame(rows, schema)).collect()}


@pytest.mark.parametrize("html, want", [
    ('<body class="has-sidebar"><p>text</p></body>', "text"),
    ('<body class="single comments-open right-sidebar"><article><p>text</p></article></body>', "text"),
    ('<body class="comments"><p>text</p></body>', "text"),
    ('<article class="post comments-open"><p>text</p></article>', "text"),
    ('<main class="no-ads"><p>text</p></main>', "text"),
    ('<main class="ads"><p>text</p></main>', "text"),
    ("<form id=f><main><p>text</p></main></form>", "text"),
    ('<div class="sidebar"><article><p>text</p></article></div>', "text"),
    ('<article class="widget"><p>text</p></article>', "text"),
    ('<article><p>text</p><div id="notice-of-appeal">more</div></article>', "text\nmore"),
    ('<article><header><h1>Title</h1></header><p>text</p></article><header>Site</header>', "Title\ntext"),
    ('<article><p>text</p></article><section class="comments"><article class="comment">no</article></section>', "text"),
    ('<article><p>text</p></article><aside><article>teaser</article></aside>', "text"),
    ('<p>a <b>b <div>c</b> d</div> e', "a b\nc d\ne"),
    ("<p>1 < 2 &lt; 3 <!-- no --> x</p><p>y <a href='>'>z</a><script>no</script>", "1 < 2 < 3 x\ny z"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><table><tr><td>e<td>f<tr><td>g</table>", "a\nb\nc\nd\ne\nf\ng"),
    ("text <a href=", "text"),
    ("text <!-- no", "text"),
    ("<title>no</title><textarea>no</textarea>text</p></div>", "text"),
])
def test_no_text_is_lost_by_a_name(html, want):
    assert pages.main_text(html) == want


@pytest.mark.parametrize("part", ["<a '", "<a ", "<div>", "<b>", "<p><b>", "</b>", "<li>", "<dd><b>", "<a b='>", '<a b="', "<!", "<", "<script>", "&amp;", "<a b= ", "<article>", "<table><td>", "<b></i>"])
def test_pages_are_parsed_in_linear_time(part):
    import time

    for html in (part * (1_000_000 // len(part)), "<div>" * 50_000 + part * 50_000, "<b>" * 50_000 + (part + "</dd></p>") * 50_000):
        began = time.time()
        pages.parsed(html)
        assert time.time() - began < 5
    pages.main_text(part * 20_000)


def test_templates_decide_without_an_article(spark):
    """Pages without article, main or any name of furniture: what recurs on the host goes."""
    shell = "<div><p><b>News of {h}</b></p><div><a href=/a>One</a> <a href=/b>Two</a></div><div><p>{t}</p><p>second {t}</p><div>read also</div></div><p>Made by {h}</p></div>"
    rows = [(10 * h + i, f"https://h{h}.org/{i}", shell.format(h=h, t=f"story {h} {i}")) for h in range(3) for i in range(8)]
    assert extracted(spark, rows) == {10 * h + i: f"story {h} {i}\nsecond story {h} {i}" for h in range(3) for i in range(8)}
    # The same page alone on its host is all there is to see.
    assert extracted(spark, rows[:1])[0] == "News of 0\nOne Two\nstory 0 0\nsecond story 0 0\nread also\nMade by 0"


def test_templates_within_articles(spark):
    """Blocks that recur in half of a host's articles go; an article that was copied, as a whole or nearly, stays."""
    box = "<div><p>Sign up for our letter</p></div>"
    rows = [(i, f"http://h/{i}", f"<article><p>story {i} is {'long ' * 9}</p>{box}<p>end {i}</p></article>") for i in range(10)]
    want = {i: f"story {i} is {'long ' * 8}long\nend {i}" for i in range(10)}
    assert extracted(spark, rows) == want
    same = [(100 + i, f"http://h/c{i}", f"<nav>{i}</nav><article><p>a copied story</p><p>of two parts</p></article>") for i in range(60)]
    near = [(200 + i, f"http://g/{i}", f"<article><p>a long copied story of many words</p><p>of two parts</p><p>no {i}</p></article>") for i in range(60)]
    assert extracted(spark, rows + same + near) == want | {100 + i: "a copied story\nof two parts" for i in range(60)} | {200 + i: f"a long copied story of many words\nof two parts\nno {i}" for i in range(60)}


def test_names_go_where_the_host_agrees(spark):
    ad = "<article><p>story {i}</p><div class='ad big'>buy {i}</div></article>"
    rows = [(i, f"http://h/{i}", ad.format(i=i)) for i in range(6)] + [(9, "http://h/9", "<article><p>story</p><section class='related work'><p>others</p></section></article>")]
    assert extracted(spark, rows) == {i: f"story {i}" for i in range(6)} | {9: "story\nothers"}


def test_page_edges(spark):
    rows = [(1, None, None, "x", 1), (2, None, "<p>a", "y", 2), (2, None, "<p>a", "y", 2), (None, "http://h", "<p>b", None, None), (3, "http://h", "", "z", 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, found int")
    out = sorted(((r.page_id or 0, r.text, r.n_chars) for r in pages.main_texts(df).collect()))
    assert out == [(0, "b", 1), (1, "", 0), (2, "a", 1), (2, "a", 1), (3, "", 0)]
    assert pages.main_texts(df.limit(0)).collect() == []
    long = "<article>" + "<p>" + "w " * 500_000 + "</p></article>"
    assert extracted(spark, [(1, "http://h", long)]) == {1: ("w " * 500_000).strip()}


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = corpus_pipeline.keep_quality(spark, docs, sf_dir)
    assert kept.columns == docs.columns and np.mean([labels.get(r.doc_id, 1) for r in kept.collect()]) > 0.9
    out = corpus_pipeline.run(spark, sf_dir)
    assert 0 < out.count() <= docs.count() and "ids" in out.columns


def plain_score(text, weights):
    """The classifier's probability, gram by gram."""
    import xxhash

    words, most = (text or "").split(), 1 << 64
    hashes = [[xxhash.xxh3_64_intdigest(w.lower()), xxhash.xxh3_64_intdigest(quality.shape(w))] for w in words]
    for k in range(len(words) - 1, 0, -1):
        if hashes[k][0] == hashes[k - 1][0]:
            hashes[k][1] = 1
    z = weights[-1]
    for column, longest in ((0, 2), (1, 3)):
        for n in range(1, longest + 1):
            slots = []
            for k in range(len(words) - n + 1):
                g = hashes[k][column]
                for m in range(1, n):
                    g = (g * 0x9E3779B97F4A7C15 + hashes[k + m][column] * 0xC2B2AE3D27D4EB4F) % most
                slots.append((((g ^ (g >> 29)) * 0xBF58476D1CE4E5B9) % most) >> (64 - quality.DIM_BITS))
            if slots:
                z += quality.Ftrl.scale * sum(weights[s] for s in slots) / len(slots)
    return 1 / (1 + math.exp(-z))


def plain_pipeline(docs, items, weights):
    """The five stages by loops over texts."""
    import tiktoken

    docs = {i: t for i, t in docs.items() if plain_score(t, weights) >= quality.THRESHOLD}
    seen, long, out = set(), set(), {}
    for i in sorted(docs):
        lines_ = docs[i].split("\n")
        solid = [k for k, x in enumerate(lines_) if x.strip(" \t\r")]
        runs = [(tuple(lines_[k].strip(" \t\r") for k in solid[a : a + 3]), solid[a : a + 3]) for a in range(len(solid) - 2)]
        gone = {k for run, at in runs if run in seen for k in at}
        seen |= {run for run, _ in runs}
        for k in solid:
            if len(lines_[k].split()) > 50:
                if (x := lines_[k].strip(" \t\r")) in long:
                    gone.add(k)
                long.add(x)
        text = "\n".join(x for k, x in enumerate(lines_) if k not in gone)
        if not gone or text.strip(" "):
            out[i] = text
    order = sorted(out)
    low = brute_components([(k, out[i].lower()) for k, i in enumerate(order)], 5, 80)
    docs, out = {i: out[i] for k, i in enumerate(order) if low[k] == k}, {}
    windows = set()
    for item in items:
        w = re.findall(r"[0-9a-z]+", item.lower())
        windows |= {tuple(w[k : k + min(10, len(w))]) for k in range(len(w) - min(10, len(w)) + 1)}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(byte_bpe.RANKS), "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, text in docs.items():
        at = list(re.finditer(r"[0-9A-Za-z]+", text))
        words = [m[0].lower() for m in at]
        hit = {k + d for n in {len(w) for w in windows} for k in range(len(words) - n + 1) if tuple(words[k : k + n]) in windows for d in range(n)}
        if len(hit) > 0.5 * len(words):
            continue
        parts, done = [], 0
        for k in sorted(hit):
            if k - 1 not in hit:
                parts.append(text[done : at[k].start()].rstrip(" "))
            done = at[k].end()
        out[i] = own.encode_ordinary("".join(parts) + text[done:])
    return out


def test_pipeline_against_brute_force(spark, tmp_path):
    import corpus_pipeline

    rng = np.random.default_rng(21)
    make = lambda n: " ".join("".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 8))) for _ in range(n))
    docs = {k: "\n".join(make(12) for _ in range(5)) for k in range(40)} | {k: " ".join(rng.choice(["!!!", "###", "$$$1", "%%%"], 60)) for k in range(40, 70)}
    passage, three, one = make(14), "\n".join(make(6) for _ in range(3)), make(60)
    docs |= {100: one, 101: one + " more", 102: make(3) + "\n" + one, 103: f"{make(20)}\n{one}\n{make(20)}"}  # near copies, and a long line again
    docs |= {110: f"{make(9)}\n{three}\n{make(9)}", 111: f"{make(8)}\n{three}\n{make(20)}", 112: three}
    docs |= {120: f"{make(20)} {passage}, {make(20)}", 121: f"{make(4)} {passage.upper()}", 122: f"{make(30)}\n{make(5)} x y z {make(9)}"}
    labels = [(k, int(k < 40), 0) for k in range(70)]
    items = [passage, "x y z"]
    spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in docs.items()], "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    weights = quality.train(spark.read.parquet(str(tmp_path / "documents.parquet")), spark.read.parquet(str(tmp_path / "labels.parquet")))
    want = plain_pipeline(docs, items, weights)
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == want
    assert {100, 110, 120, 122} <= set(got) and not {101, 112, 121} & set(got) and not set(range(40, 70)) & set(got)


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_odd_and_empty_tables(spark, sf_dir, odd, stage):
    import corpus_pipeline

    name, run = corpus_pipeline.STAGES[stage]
    for df in (odd, odd.limit(0)):
        out = run(spark, df, sf_dir)
        rows = out.collect()
        assert len(rows) <= len(ODD) and (name == "byte_bpe" or out.columns == df.columns)
        if df is odd and name in ("decontamination", "byte_bpe"):
            assert Counter(r.doc_id for r in rows) == Counter(x[0] for x in ODD)
