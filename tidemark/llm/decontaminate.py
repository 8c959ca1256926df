"""Benchmark decontamination by a generalised suffix automaton over words."""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .common import ALNUM, map_batches, table, texts, written

WINDOW = 10
#: Words of test items in one automaton, which every task holds (about 200 bytes a word, measured); more items take further
#: passes.
ITEM_WORDS = 1_000_000
FOUND = (StructField("hits", ArrayType(ArrayType(IntegerType()))), StructField("items", ArrayType(LongType())), StructField("n_words", LongType()))
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(ALNUM).split() if text else []


class Automaton:
    """All substrings of all items, over word numbers. For the states at which a window of `window` words ends, the items that
    hold it; for those at which a short item ends, its length and the item.

    States are places in arrays. Most have one way on, which is a word and a state there; only those with more have a
    dictionary."""

    def __init__(self, items: list[tuple[int, list[bytes]]], window: int = WINDOW):
        self.window, self.word = window, {}
        self.link, self.len, self.by, self.to, self.more = array("i", [-1]), array("i", [0]), array("i", [-1]), array("i", [-1]), {}
        for _, words in items:
            last = 0
            for w in words:
                last = self._add(last, self.word.setdefault(w, len(self.word)))
        self.holds: dict[int, list[int]] = {}
        self.short: dict[int, list[tuple[int, int]]] = {}
        for item, words in items:
            state = length = 0
            for w in words:
                state, length = self.step(state, length, self.word[w])
                if length == window:
                    held = self.holds.setdefault(state, [])
                    if not held or held[-1] != item:
                        held.append(item)
            if 0 < len(words) < window:
                self.short.setdefault(state, []).append((len(words), item))
        # For each state the nearest one, itself or up its links, at which a short item ends.
        self.near = array("i", [-1]) * len(self.len)
        if self.short:
            for v in sorted(range(1, len(self.len)), key=self.len.__getitem__):
                self.near[v] = v if v in self.short else self.near[self.link[v]]
        self.least = min([window, *(len(w) for _, w in items if w)])

    def go(self, state: int, c: int) -> int:
        """The state after word c, -1 for none."""
        if self.by[state] == c:
            return self.to[state]
        return self.more[state].get(c, -1) if state in self.more else -1

    def _put(self, state: int, c: int, to: int) -> None:
        if self.by[state] in (-1, c):
            self.by[state], self.to[state] = c, to
        else:
            self.more.setdefault(state, {})[c] = to

    def _state(self, length: int, link: int) -> int:
        self.len.append(length)
        self.link.append(link)
        self.by.append(-1)
        self.to.append(-1)
        return len(self.len) - 1

    def _add(self, last: int, c: int) -> int:
        if (q := self.go(last, c)) >= 0:
            return q if self.len[q] == self.len[last] + 1 else self._split(last, c, q)
        cur, p = self._state(self.len[last] + 1, 0), last
        while p >= 0 and self.go(p, c) < 0:
            self._put(p, c, cur)
            p = self.link[p]
        if p >= 0:
            q = self.go(p, c)
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._split(p, c, q)
        return cur

    def _split(self, p: int, c: int, q: int) -> int:
        clone = self._state(self.len[p] + 1, self.link[q])
        self.by[clone], self.to[clone] = self.by[q], self.to[q]
        if q in self.more:
            self.more[clone] = dict(self.more[q])
        self.link[q] = clone
        while p >= 0 and self.go(p, c) == q:
            self._put(p, c, clone)
            p = self.link[p]
        return clone

    def step(self, state: int, length: int, c: int) -> tuple[int, int]:
        """The state and length of the longest match, of at most `window` words, that ends with word c."""
        while (to := self.go(state, c)) < 0 and state:
            state = self.link[state]
            length = self.len[state]
        if to < 0:
            return 0, 0
        state, length = to, length + 1
        while self.len[self.link[state]] >= self.window:
            state = self.link[state]
        return state, min(length, self.window)

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged spans of words [from, to) inside occurrences of windows, and the items whose windows occur."""
        ids = list(map(self.word.get, words))
        spans: list[tuple[int, int]] = []
        items: set = set()
        n, at = len(ids), 0
        window, step = self.window, self.step
        while at < n:
            if ids[at] is None:
                at += 1
                continue
            end = at
            while end < n and ids[end] is not None:
                end += 1
            if end - at >= self.least:
                state = length = 0
                for k in range(at, end):
                    state, length = step(state, length, ids[k])
                    if length == window:
                        spans.append((k + 1 - window, k + 1))
                        items.update(self.holds[state])
                    p = self.near[state]
                    while p >= 0:
                        for m, item in self.short[p]:
                            if m <= length:
                                spans.append((k + 1 - m, k + 1))
                                items.add(item)
                        p = self.near[self.link[p]]
            at = end
        return merge(spans), items


def runs_of(benchmark: DataFrame, id_col: str, text_col: str, most: int, window: int = WINDOW) -> Iterator[list[tuple[int, list[bytes]]]]:
    """The items in runs of at most `most` words (or a window's, where that is more); the driver holds one run and one item's text at a
    time. A longer item is cut into pieces that overlap by window - 1 words: each of its windows lies in one of them. Without items, one
    empty run."""
    most = max(most, window)
    run, words = [], 0
    rows = benchmark.select(benchmark[id_col].cast("long"), benchmark[text_col].cast("string")).where(F.col(text_col).isNotNull())
    for item, text in rows.toLocalIterator():
        if item is None or not (own := words_of(text)):
            continue
        for at in range(0, max(len(own) - window, 0) + 1, most - window + 1):
            piece = own[at : at + most]
            if run and words + len(piece) > most:
                yield run
                run, words = [], 0
            run.append((item, piece))
            words += len(piece)
    yield run


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, item_words: int = ITEM_WORDS, carry: bool = False) -> DataFrame:
    """One row for each row of docs: doc_id, text, n_words, hits (array of word spans [from, to)), items (sorted list of
    item ids as longs).

    The automaton is built once in each task from the items, whose words are counted: beyond item_words the items are dealt
    with in several passes, whose hits are put together by row. Null and empty texts have no words and no hits; an item
    without words, or without an id, is no item; repeated rows give repeated results. No shuffle for items of one pass.
    """
    runs = runs_of(benchmark, item_id_col, item_text_col, item_words, window)
    own, run = texts(docs, id_col, text_col, carry), next(runs)
    following = next(runs, None)
    if following is None:
        return found_in(own, run, window)
    # Rows get a number, in a table that is written once; each pass writes hits alone.
    own = written(own.withColumn("row", F.monotonically_increasing_id()), "rows")
    passes = []
    while run is not None:
        found = found_in(own.select("row", "text"), run, window)
        passes.append(written(found.select("row", "n_words", "hits", "items").where("size(hits) > 0"), "hits"))
        run, following = following, next(runs, None)
    each = passes[0]
    for more in passes[1:]:
        each = each.union(more)
    both = each.groupBy("row").agg(F.flatten(F.collect_list("hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def make():
        def step(cols):
            merged = [[list(x) for x in merge([tuple(x) for x in hits or ()])] for hits in cols["hits"]]
            yield cols | {"hits": merged, "items": [x or [] for x in cols["items"]], "n_words": [len(words_of(t)) for t in cols["text"]]}

        return step

    out = own.join(both, "row", "left").drop("row")
    return map_batches(out, make, StructType([*out.schema.fields, FOUND[-1]]))


def found_in(own: DataFrame, run: list[tuple[int, list[bytes]]], window: int) -> DataFrame:
    """own with n_words, hits and items of one run of benchmark items."""
    sent = own.sparkSession.sparkContext.broadcast([(item, b" ".join(words)) for item, words in run])

    def make():
        auto = Automaton([(item, words.split()) for item, words in sent.value], window)

        def step(cols):
            n, hits, items = [], [], []
            for text in cols["text"]:
                words = words_of(text)
                spans, found = auto.hits(words)
                n.append(len(words))
                hits.append([list(x) for x in spans])
                items.append(sorted(found))
            yield cols | {"hits": hits, "items": items, "n_words": n}

        return step

    return map_batches(own, make, StructType([*own.schema.fields, *FOUND]))


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, max_span: int = WINDOW, max_coverage: float = 0.5, **names) -> DataFrame:
    """doc_id, text, n_removed of each document that stays: spans of max_span hit words or more (or whole short items) are cut
    out of the text, with the blank before them; a document of which more than max_coverage is hit goes altogether.
    Documents without hits keep their text unchanged, null texts stay null."""
    found = contamination(docs, benchmark, window=max_span, **names)

    def make():
        def step(cols):
            keep = {"doc_id": [], "text": [], "n_removed": []} | ({"carried": []} if "carried" in cols else {})
            for i, text, n, hits, more in zip(cols["doc_id"], cols["text"], cols["n_words"], cols["hits"], cols.get("carried", cols["doc_id"]), strict=True):
                gone = sum(b - a for a, b in hits)
                if gone > max_coverage * n:
                    continue
                if hits:
                    raw = text.encode()
                    at = [m.span() for m in WORD.finditer(raw)]
                    parts, done = [], 0
                    for a, b in hits:
                        parts.append(raw[done : at[a][0]].rstrip(b" "))
                        done = at[b - 1][1]
                    text = b"".join([*parts, raw[done:]]).decode()
                for k, v in (("doc_id", i), ("text", text), ("n_removed", gone), ("carried", more)):
                    if k in keep:
                        keep[k].append(v)
            yield keep

        return step

    schema = StructType([f for f in found.schema if f.name in ("doc_id", "text", "carried")]).add("n_removed", "long")
    return map_batches(found, make, schema)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document lie in windows of benchmark items, and in which; odd rows as in the functions it calls."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    # The digest needs the ids in the order of their text.
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda s, x: s + (x[1] - x[0]).cast("long"))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


def digest(items: list[int]) -> str:
    """What items_sha256 holds, for tests."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
