"""Spelling variants, whitening and source mixing against brute force, and their edge cases."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import mixing, spelling, whiten

DOCS = "doc_id long, text string, source string, size string, n int"


def by_row(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


# ---- spelling


def words_of(docs):
    found = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            found[w] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def near(words):
    """Near words by what is left without one code point: equal remains at equal places are one replaced, a remain that is a word one inserted."""
    gaps = {}
    for w in words:
        for i in range(len(w)):
            gaps.setdefault((i, w[:i] + w[i + 1 :]), set()).add(w)
    out = {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            rest = w[:i] + w[i + 1 :]
            out[w] |= gaps[i, rest] - {w}
            if rest in out:
                out[w].add(rest)
                out[rest].add(w)
    return out


def variants(docs):
    n = words_of(docs)
    forms, rows = {}, Counter()
    close = near(n)
    for w in n:
        best = min(close[w], key=lambda x: (-n[x], x), default=None)
        forms[w] = best if best and n[best] >= 10 * n[w] else None
    for w in n:
        root = w
        while forms[root]:
            root = forms[root]
        rows[w, forms[w], root, n[w], len(close[w]), n[forms[w]] if forms[w] else None] += 1
    return rows


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def test_variants_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = variants([(r.doc_id, r.text) for r in docs.collect()])
    assert len(want) > 1000 and sum(1 for w in want if w[1]) >= 10
    assert by_row(spelling.variants(docs), *COLUMNS) == want


@pytest.mark.parametrize("block", [3, 8192])
def test_variants_of_few_letters(spark, block):
    """Words of three letters have very many near ones, halves that most share, and chains of forms."""
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abÿ"), rng.integers(7, 10))) for _ in range(300)] + [f"aaaaaaa{x}" for x in ("", "a", "aa", "b", "ba")]
    # Counts from 2 to 20,000, so that forms have forms.
    docs = [(i, " ".join([w] * int(10 ** rng.uniform(0.4, 4.3)))) for i, w in enumerate(words)]
    want = variants(docs)
    assert any(w[1] and w[1] != w[2] for w in want)
    assert by_row(spelling.variants(spark.createDataFrame(docs, "doc_id long, text string"), block=block), *COLUMNS) == want


def test_variants_of_odd_rows(spark):
    docs = [(1, None), (2, ""), (None, "Garden garden GARDEN gardens gardens"), (3, "Strasse Straße straße Straßen " * 6), (3, "x" * 9_000 + " " + "y" * 9_000), (4, "x" * 9_000), (5, "x" * 8_999), (6, "x" * 8_999), (7, "ÉCOLIERS Écoliers écoliers")]
    df = spark.createDataFrame([(*d, "en", "s", 1) for d in docs], "doc_id long, text string, word string, n string, root int")
    assert by_row(spelling.variants(df), *COLUMNS) == variants(docs)
    assert spelling.variants(df.limit(0)).count() == 0


# ---- whitening


def whitened(rows, most=32):
    """n, deviations, eigenvalues, components as columns and whitened values, from one covariance in memory."""
    x = np.floor(64 * np.array([v for _, v in rows])).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    z = (n * x - s).astype(np.float64) / n
    e, v = np.linalg.eigh(z.T @ z / n)
    e, v = e[::-1][:most], v[:, ::-1][:, :most]
    return n, ((n * x - s) ** 2).sum(axis=1), e / np.trace(z.T @ z / n), z @ v / np.sqrt(e)


def held(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.vec_id, {})[r.component] = r
    return out


def agree(got, rows, most=32):
    n, deviation, share, want = whitened(rows, most)
    k = want.shape[1]
    assert {len(got[i]) for i, _ in rows} == {k}
    w = np.array([[got[i][c].whitened for c in range(1, k + 1)] for i, _ in rows])
    signs = np.sign((w * want).sum(axis=0))
    assert np.abs(w * signs - want).max() < 1e-7
    for (i, _), d in zip(rows, deviation.tolist(), strict=True):
        assert got[i][1].deviation == d and got[i][1].n == n
        assert got[i][1].identity_error < 1e-9
    assert np.abs(np.array([got[rows[0][0]][c].explained for c in range(1, k + 1)]) / share - 1).max() < 1e-9


def test_whitening_of_embeddings(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    agree(held(whiten.whitened(table)), [(r.vec_id, r.embedding) for r in table.collect()])


def test_whitening_of_very_unlike_scales(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((500, 6)) * [1e3, 100, 30, 10, 3, 1] @ np.linalg.qr(rng.standard_normal((6, 6)))[0]
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    agree(held(whiten.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))), rows)


def test_whitening_of_dependent_dimensions(spark):
    """Constant dimensions and sums of others leave as many components as there are independent ones."""
    rng = np.random.default_rng(4)
    a = rng.integers(-500, 500, (300, 3))
    x = np.concatenate([a, a[:, :1] + a[:, 1:2], np.full((300, 1), 7), a[:, 2:] * 64], axis=1) / 64
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    agree(held(whiten.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))), rows, 3)


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(6)
    good = [(i, v) for i, v in enumerate(rng.standard_normal((40, 4)).tolist())]
    odd = [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [float("nan"), 1.0, 1.0, 1.0]), (103, [float("inf"), 1.0, 1.0, 1.0]), (104, [])]
    short = [(200 + i, v) for i, v in enumerate(rng.standard_normal((30, 2)).tolist())]
    kind = "vec_id long, embedding array<float>, component string, n string"
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in good + odd + short], kind)
    got = held(whiten.whitened(df))
    assert set(got) == {i for i, _ in good + short}  # what isn't usable goes; lengths are spaces of their own
    single = [(i, np.array(v, np.float32).astype(float).tolist()) for i, v in good]
    agree(got, single)
    agree(got, [(i, np.array(v, np.float32).astype(float).tolist()) for i, v in short])
    assert whiten.whitened(df.limit(0)).count() == 0
    # Equal vectors have no variance, so no components; repeated rows and null ids stay.
    assert whiten.whitened(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<double>")).count() == 0
    twice = spark.createDataFrame([(None, [1.0]), (1, [2.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert sorted(str(r.vec_id) for r in whiten.whitened(twice).collect()) == ["1", "1", "None"]


# ---- mixing


def goals(size):
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(size, key=lambda s: (s is None, s or "")))}
    full, total = set(), 1.5 * sum(size.values())
    while True:
        among = sum(w for s, w in weight.items() if s not in full)
        rest = total - sum(2 * size[s] for s in full)
        more = {s for s in size if s not in full and weight[s] * rest / among >= 2 * size[s]}
        if not more:
            return {s: 2.0 * size[s] if s in full else weight[s] * rest / among for s in size}
        full |= more
        if len(full) == len(size):
            return {s: 2.0 * size[s] for s in size}


def sizes(rows):
    return [(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), s) for i, t, s in rows]


@pytest.mark.parametrize("block", [4, 64])
def test_mix(spark, block):
    rng = np.random.default_rng(7)
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(int(rng.integers(0, 60)))), ["a", "b", "c", None, "é", "z"][min(int(rng.exponential(1)), 5)]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = mixing.written(mixing.sized(df), "sized")
    goal = mixing.written(mixing.targets(kept), "goal")
    size = Counter()
    for _, n, s in sizes(rows):
        size[s] += n
    want = goals(size)
    assert {r.source: r.target for r in goal.collect()} == want
    mixed = mixing.with_text(mixing.mix(kept, goal, block), df).collect()
    words, taken = {i: (t or "").split() for i, t, _ in rows}, Counter()
    for r in mixed:
        assert r.text.split() == words[r.doc_id][r.first : r.first + r.words]
        taken[r.source] += r.words
    assert taken == Counter({s: int(t + 0.5) for s, t in want.items() if t})
    # Slots are numbered without a gap and blocks are full but for a source's last ones; each source comes in turn with its share.
    slots = mixing.schedule(goal, block).orderBy("slot").collect()
    once = Counter((r.source, r["rank"]) for r in slots)
    assert set(once.values()) == {1}
    per = Counter(r.source for r in slots)
    for cut in range(len(slots) // 8, len(slots), len(slots) // 8):
        part = Counter(r.source for r in slots[:cut])
        for s in per:
            assert abs(part[s] - cut * per[s] / len(slots)) <= 2 + np.log2(len(slots))
    # A source's words of one turn are each of its words once.
    for r in [r for r in goal.collect() if r.want >= r.source_size]:
        full = Counter(f"{m.doc_id}/{w}" for m in mixed if m.source == r.source and m["rank"] < -(-r.source_size // block) for w in range(m.first, m.first + m.words))
        assert set(full.values()) == {1} and len(full) == r.source_size


def test_mix_of_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "p q r", "a"), (3, "x " * 5000, None), (4, "d e f g", "b"), (4, "d e f g", "b"), (4, "d e f g", "b"), (4, "h", "b"), (5, " \n\t", "empty"), (6, "one of two and more in 日本", "日本")]
    df = spark.createDataFrame([(i, t, s, "big", 3) for i, t, s in rows], DOCS)
    got = mixing.taken(df, block=8).collect()
    size = Counter()
    for _, n, s in sizes(rows):
        size[s] += n
    want = goals(size)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, n) for i, n, _ in sizes(rows))
    for s in size:  # no two sources are of one size
        assert sum(r.taken for r in got if r.source_size == size[s]) == int(want[s] + 0.5), (s, got)
    assert all(r.taken <= 2 * r.size for r in got)
    again = mixing.taken(df.repartition(7), block=8).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert mixing.taken(df.limit(0)).count() == 0
    assert [r.taken for r in mixing.taken(df.where("size = 'big' and doc_id = 2")).collect()] == [0]


def test_mix_of_many_small_sources_and_one_hot_id(spark):
    rows = [(7, "a b c", "hot")] * 300 + [(i, "one two three", f"s{i}") for i in range(100, 300)]
    got = mixing.taken(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5), block=2).collect()
    size = Counter()
    for _, n, s in sizes(rows):
        size[s] += n
    want = goals(size)
    assert sum(r.taken for r in got) == sum(int(t + 0.5) for t in want.values())
    assert all(r.taken <= 2 * r.size for r in got)
    hot = [r.taken for r in got if r.doc_id == 7]
    assert sum(hot) == int(want["hot"] + 0.5) and len(hot) == 300
