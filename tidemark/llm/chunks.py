"""Substring dedup by content-defined chunks: cut by a gear rolling hash, deduplicated by digest, ends compared by windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, table, texts, written

#: Words of the shortest passage, and of the gram that a cut is known by. A gram has 2 * GRAM - 1 bytes or more, so the 32 bytes
#: that decide the gear hash at its end lie within it.
WORDS, GRAM = 50, 25
_GEAR = np.random.default_rng(7).integers(0, 1 << 32, 256, dtype=np.uint32)
_BYTE = np.random.default_rng(8).integers(0, 1 << 64, 256, dtype=np.uint64)
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Odd, so that powers have inverses modulo 2^64.
_BASE = 0x9E3779B97F4A7C15


def gear(raw: np.ndarray) -> np.ndarray:
    """The gear hash after each byte, h = 2h + G[byte] in 32 bits: the last 32 bytes decide it. The sums over windows of 1, 2,
    4 ... bytes are doubled, so a text takes five passes instead of a step for each byte."""
    h = _GEAR[raw]
    for k in range(5):
        w = 1 << k
        if len(h) > w:
            h = np.concatenate([h[:w], h[w:] + (h[:-w] << np.uint32(w))])
    return h


def mixed(x: np.ndarray) -> np.ndarray:
    """The finisher of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the base and of its inverse modulo 2^64, as many as the longest text so far takes."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            self.up, self.down = (np.cumprod(np.append(np.ones(1, np.uint64), np.full(n, b, np.uint64)), dtype=np.uint64) for b in (_BASE, pow(_BASE, -1, 1 << 64)))


class Words:
    """Places of a text's words, which blanks and line ends part, and hashes of any run of them with the bytes between."""

    def __init__(self, text: str, powers: Powers):
        raw = np.frombuffer(text.encode(), np.uint8)
        solid = np.concatenate([[False], ~_BLANK[raw], [False]])
        edge = np.flatnonzero(solid[1:] != solid[:-1])
        self.start, self.end, self.powers = edge[::2], edge[1::2], powers
        if len(self.start) < WORDS:
            return
        self.gear = gear(raw)[self.end[GRAM - 1 :] - 1]
        powers.reach(len(raw) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * powers.up[: len(raw)], dtype=np.uint64)])
        word = lambda end: mixed((sums[end] - sums[self.start]) * powers.down[self.start] + (end - self.start).astype(np.uint64))
        bare, full = word(self.end), word(np.append(self.start[1:], self.end[-1]))
        self.lanes = []
        for salt in (np.uint64(1), np.uint64(2)):
            own = mixed(full + salt) * powers.up[: len(full)]
            self.lanes.append((np.concatenate([np.zeros(1, np.uint64), np.cumsum(own, dtype=np.uint64)]), mixed(bare - salt)))

    def hashes(self, a: np.ndarray, b: np.ndarray, lane: int) -> np.ndarray:
        """64 bits of the words a to b - 1 of each pair; the bytes after the last word don't count."""
        sums, last = self.lanes[lane]
        return mixed((sums[b - 1] - sums[a]) * self.powers.down[a] + last[b - 1] * np.uint64(0xD6E8FEB86659FD93) + (b - a).astype(np.uint64))

    def chunks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, word behind the last and cut of each chunk.

        A window of WORDS words is cut behind the gram whose gear hash is its lowest, the first of several; a chunk is a longest run
        of windows with equal cuts. So a passage's cuts follow from its own bytes, wherever it stands, no chunk is longer than two
        windows unless the text repeats itself, and chunks overlap by WORDS - 1 words: no passage falls between two."""
        at = np.arange(len(self.gear))
        best, width, want = self.gear.astype(np.uint64) << np.uint64(32) | at.astype(np.uint64), 1, WORDS - GRAM + 1
        while width < want:  # minima of 1, 2, 4 ... and at last of all grams of a window
            more = min(width, want - width)
            best, width = np.minimum(best[:-more], best[more:]), width + more
        chosen = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
        place = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
        cut = self.hashes(chosen[place], chosen[place] + GRAM, 0)
        other = np.append(True, cut[1:] != cut[:-1])  # a text that repeats itself has the same gram at many places
        first = place[other]
        return first, np.append(first[1:], len(best)) + WORDS - 1, cut[other]


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def per_text(docs: DataFrame, rows_of_text, schema: str) -> DataFrame:
    """rows_of_text(words, own) of each text of WORDS words or more, a tuple of arrays, after its doc_id and tag."""
    names = [c.split()[0] for c in schema.split(", ")]

    def make():
        powers = Powers()

        def step(cols):
            parts: list = []
            for i, tag, text, own in zip(cols["doc_id"], cols["tag"], cols["text"], cols.get("own") or [None] * len(cols["text"]), strict=True):
                words = Words(text, powers)
                if len(words.start) >= WORDS:
                    got = rows_of_text(words, own)
                    parts.append((np.full(len(got[0]), i, np.int64), np.full(len(got[0]), tag, np.int64), *got))
            if parts:
                yield dict(zip(names, map(np.concatenate, zip(*parts, strict=True)), strict=True))

        return step

    return map_batches(docs, make, schema)


def chunk_rows(words: Words, own: None) -> tuple[np.ndarray, ...]:
    a, b, cut = words.chunks()
    return signed(cut), signed(words.hashes(a, b, 1)), a.astype(np.int32), b.astype(np.int32), words.start[a].astype(np.int32), words.end[b - 1].astype(np.int32)


def window_rows(words: Words, own: list[dict]) -> tuple[np.ndarray, ...]:
    a = np.concatenate([np.arange(x["a"], x["b"] - WORDS + 1) for x in own])
    b = a + WORDS
    return signed(words.hashes(a, b, 0)), signed(words.hashes(a, b, 1)), a.astype(np.int32), b.astype(np.int32), words.start[a].astype(np.int32), words.end[b - 1].astype(np.int32)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Passages of WORDS words or more that earlier documents (lower ids) hold: doc_id, tag, src_doc_id, start, n_bytes, n_words.

    Every window of WORDS whole words that occurs, byte for byte, in an earlier document is found; windows that overlap make a
    span, with byte offsets into the UTF-8 text; src_doc_id is the lowest keeper in the span. Rows that share an id are one
    document for the keeping: none of them is later than the other. Each of their different texts has spans of its own, told
    apart by tag (a hash of the text); rows that repeat id and text have theirs once. Null and empty texts and null ids give no
    row. Within one document nothing is removed.

    Chunks are deduplicated by digest: one that an earlier document holds goes as a whole. Equal windows have equal cuts, so what
    is left to compare is windows within a cut that has unlike chunks, which is where matches end; only the first document's
    copies of such chunks are taken apart. Long copies cost a row for each chunk and just their ends a row for each word. All
    hashes that decide have 128 bits, for chunks with those of the cut's gram.
    """
    own = texts(docs, id_col, text_col).where("doc_id is not null and text <> ''").withColumn("tag", F.xxhash64("text"))
    place = "a int, b int, start int, end int"
    rows = written(per_text(own, chunk_rows, f"doc_id long, tag long, cut long, d1 long, {place}"), "chunks")
    keeper = written(rows.groupBy("cut", "d1").agg(F.min("doc_id").alias("src"), (F.min("doc_id") < F.max("doc_id")).alias("more")), "keepers")
    several = keeper.groupBy("cut").agg(F.min("src").alias("one"), F.max("src").alias("other")).where("one < other").select("cut", F.lit(True).alias("apart"))
    keeper = keeper.join(several, "cut", "left").where("more or apart").select("cut", "d1", "src", F.coalesce("apart", F.lit(False)).alias("apart"))
    met = written(rows.join(keeper, ["cut", "d1"]).where("doc_id > src or apart").drop("cut", "d1", "apart"), "met")
    whole = met.where("doc_id > src")
    # All places of a chunk in its first document: each of them may hold windows of an earlier one.
    apart = met.where("doc_id = src").groupBy("doc_id", "tag").agg(F.collect_list(F.struct("a", "b")).alias("own"))
    windows = written(per_text(own.join(apart, ["doc_id", "tag"]), window_rows, f"doc_id long, tag long, d1 long, d2 long, {place}"), "windows")
    first = windows.groupBy("d1", "d2").agg(F.min("doc_id").alias("src"), F.max("doc_id").alias("last")).where("src < last").drop("last")
    cols = ["doc_id", "tag", "src", "a", "b", "start", "end"]
    return joined(whole.select(*cols).union(windows.join(first, ["d1", "d2"]).where("doc_id > src").select(*cols)))


def joined(gone: DataFrame) -> DataFrame:
    """Overlapping runs of words of one text joined. All of one text's meet in a task, as its text did; rows that repeat it are
    made one before."""

    def join(key, own):
        out: dict = {"doc_id": [], "tag": [], "src_doc_id": [], "start": [], "n_bytes": [], "n_words": []}
        spans: list[list[int]] = []
        for a, b, start, end, src in sorted(zip(*(own.column(n).to_pylist() for n in ("a", "b", "start", "end", "src")), strict=True)):
            if spans and a < spans[-1][1]:
                last = spans[-1]
                last[1], last[3], last[4] = max(last[1], b), max(last[3], end), min(last[4], src)
            else:
                spans.append([a, b, start, end, src])
        for a, b, start, end, src in spans:
            for name, v in zip(out, (key[0].as_py(), key[1].as_py(), src, start, end - start, b - a), strict=True):
                out[name].append(v)
        return pa.table({n: pa.array(v, pa.int64()) for n, v in out.items()})

    once = gone.groupBy("doc_id", "tag", "a", "b", "start", "end").agg(F.min("src").alias("src"))
    return once.groupBy("doc_id", "tag").applyInArrow(join, "doc_id long, tag long, src_doc_id long, start long, n_bytes long, n_words long")


def without_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text of every row of docs, the bytes of its own text's spans cut out; a character that a cut splits goes as a
    whole. Null texts and ids stay."""
    own = spans.groupBy("doc_id", "tag").agg(F.array_sort(F.collect_list(F.struct("start", "n_bytes"))).alias("cut"))

    def make():
        def step(cols):
            texts_ = []
            for text, cut in zip(cols["text"], cols["cut"], strict=True):
                if cut:
                    data, parts, at = text.encode(), [], 0
                    for c in cut:
                        parts.append(data[at : c["start"]])
                        at = c["start"] + c["n_bytes"]
                    text = b"".join([*parts, data[at:]]).decode("utf-8", "ignore")
                texts_.append(text)
            yield {"doc_id": cols["doc_id"], "text": texts_}

        return step

    rows = texts(docs, id_col, text_col).withColumn("tag", F.xxhash64("text"))
    return map_batches(rows.join(own, ["doc_id", "tag"], "left"), make, "doc_id long, text string")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repeated passages of every document; odd rows as in the functions it calls."""
    return repeated_spans(table(spark, sf_dir, "documents"))
