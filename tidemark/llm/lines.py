"""Line dedup by winnowing over line hashes, in DataFrame and SQL functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, texts, written

#: Lines in a gram, grams in a window: every repeated run of GRAM + WINDOW - 1 lines holds a chosen gram.
GRAM, WINDOW = 2, 2
#: A line of more words than this is long enough to go on its own.
LONG = 50


def hashed(expression: str) -> str:
    """60 bits of the MD5 of a string expression, which other engines compute alike."""
    return f"cast(conv(substring(md5({expression}), 1, 15), 16, 10) as bigint)"


def with_lines(docs: DataFrame) -> DataFrame:
    """docs with lines (all) and solid (place and trimmed text of each line that isn't blank)."""
    return docs.withColumn("lines", F.expr(r"if(text is null or text = '', cast(array() as array<string>), split(text, '\n', -1))")).withColumn(
        "solid", F.expr(r"filter(transform(lines, (x, i) -> struct(i as i, trim(both ' \t\r' from x) as x)), y -> y.x <> '')")
    )


def fingerprints(docs: DataFrame, gram: int, window: int) -> DataFrame:
    """doc_id, tag (of the text), fp, pos, before, after, at: the grams of lines with the lowest hash of their window (the last
    one of equals), with the hashes of window - 1 lines on either side, the nearest first, and all these lines' places."""
    side = window - 1
    h = with_lines(docs.where("doc_id is not null")).select("doc_id", F.xxhash64("text").alias("tag"), F.expr(f"transform(solid, y -> struct({hashed('y.x')} as h, y.i as i))").alias("own"))
    # Arrays of their own: a field of `own` would be drawn out anew for each gram. And no filter by size, for Spark would compute
    # all hashes twice to push it down; short texts make no grams.
    h = h.select("doc_id", "tag", F.expr("transform(own, y -> y.h)").alias("h"), F.expr("transform(own, y -> y.i)").alias("i"))
    gram_hash = hashed(f"array_join(transform(slice(h, i + 1, {gram}), v -> cast(v as string)), ':')")
    g = h.withColumn("g", F.expr(f"if(size(h) < {gram}, cast(array() as array<bigint>), transform(sequence(0, size(h) - {gram}), i -> {gram_hash}))"))
    # Last place of the minimum of each window; a text of fewer grams is one window.
    low = f"transform(sequence(0, greatest(size(g) - {window}, 0)), s -> s + size(slice(g, s + 1, {window})) - cast(array_position(reverse(slice(g, s + 1, {window})), array_min(slice(g, s + 1, {window}))) as int))"
    p = g.withColumn("pos", F.explode(F.expr(f"if(size(g) = 0, cast(array() as array<int>), array_distinct({low}))")))
    return p.select(
        "doc_id", "tag", F.expr("g[pos]").alias("fp"), "pos", F.expr(f"reverse(slice(h, greatest(pos - {side}, 0) + 1, least(pos, {side})))").alias("before"), F.expr(f"slice(h, pos + {gram} + 1, {side})").alias("after"), F.expr(f"slice(i, greatest(pos - {side}, 0) + 1, {gram + side} + least(pos, {side}))").alias("at"),
    )


def same_start(a: str, b: str, most: int) -> str:
    """How many elements at the start of two arrays are equal in turn."""
    return f"aggregate(sequence(1, {most}), 0, (n, i) -> if(n = i - 1 and i <= size({a}) and i <= size({b}) and try_element_at({a}, i) = try_element_at({b}, i), i, n))"


def repeated_runs(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", contexts: bool = False) -> DataFrame:
    """doc_id, tag, gone, src_doc_id: runs of lines (their places in the text, blank lines count) that occurred before.

    Positions of a chosen gram are joined to its first one, in the order of doc_id and line. A match is extended both ways by
    up to window - 1 lines: with window <= gram the chosen grams of a repeated run cover all of it but those. The first position may stand in another context than the rest
    of the run; with contexts, each gram is also joined to the first position that has the same lines before it, or after it.
    """
    if window > gram:
        raise ValueError("window must not be larger than gram, or gaps could stay between chosen grams")
    p = written(fingerprints(texts(docs, id_col, text_col), gram, window), "fingerprints")
    # Minima come first in each task, so a line that a third of all texts share is a few rows by the time it is shuffled.
    place = F.struct("doc_id", "pos", "before", "after")
    first = written(p.groupBy("fp").agg(F.min(place).alias("src"), F.max(F.struct("doc_id", "pos")).alias("end")).where("src.doc_id < end.doc_id or src.pos < end.pos").select("fp", "src"), "first")
    # Two plain inputs: a hot fingerprint's rows are split among tasks.
    met = p.join(first, "fp").where("doc_id > src.doc_id or doc_id = src.doc_id and pos > src.pos")
    side = max(window - 1, 0)
    back, on = (same_start(c, f"src.{c}", side) if side else "0" for c in ("before", "after"))
    out = met.select("doc_id", "tag", F.expr(f"slice(at, least(pos, {side}) - {back} + 1, {back} + {gram} + {on})").alias("gone"), F.col("src.doc_id").alias("src_doc_id"))
    for n in range(1, side + 1) if contexts else ():
        for c, lead, tail in (("before", n, 0), ("after", 0, n)):
            own = p.where(f"size({c}) >= {n}").select("doc_id", "tag", "fp", "pos", "at", F.expr(f"slice({c}, 1, {n})").alias("ctx"))
            low = own.groupBy("fp", "ctx").agg(F.min(F.struct("doc_id", "pos")).alias("src"), F.max(F.struct("doc_id", "pos")).alias("end")).where("src < end").select("fp", "ctx", "src")
            near = own.join(written(low, "first"), ["fp", "ctx"]).where("doc_id > src.doc_id or doc_id = src.doc_id and pos > src.pos")
            out = out.union(near.select("doc_id", "tag", F.expr(f"slice(at, least(pos, {side}) - {lead} + 1, {gram + lead + tail})").alias("gone"), F.col("src.doc_id").alias("src_doc_id")))
    return out


def repeated_lines(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, tag, gone, src_doc_id: single lines of more than `words` words that occurred before."""
    own = with_lines(texts(docs, id_col, text_col).where("doc_id is not null")).select("doc_id", F.xxhash64("text").alias("tag"), F.explode(F.expr(rf"filter(solid, y -> size(split(y.x, '\\s+')) > {words})")).alias("y"))
    p = written(own.select("doc_id", "tag", F.expr(hashed("y.x")).alias("h"), F.col("y.i").alias("i")), "long_lines")
    first = written(p.groupBy("h").agg(F.min(F.struct("doc_id", "i")).alias("src"), F.max(F.struct("doc_id", "i")).alias("end")).where("src < end").select("h", "src"), "first")
    met = p.join(first, "h").where("doc_id > src.doc_id or doc_id = src.doc_id and i > src.i")
    return met.select("doc_id", "tag", F.array("i").alias("gone"), F.col("src.doc_id").alias("src_doc_id"))


def dedup_lines(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", carry: bool = False, long_line: int | None = None, contexts: bool = False) -> DataFrame:
    """One row for each row of docs: doc_id, text (without later repeated runs), n_lines, n_removed.

    Every run of gram + window - 1 lines or more that occurred before, in this text or one with a lower id, goes; shorter ones
    of gram lines may. Lines are equal after trimming blanks, tabs and carriage returns; blank lines neither count nor go.
    A text without repeated runs stays as it is, null stays null, a null id is left alone. Rows that share an id and a text
    are one document, none of them is later than the other; other columns are left out or, with carry, in a struct. With
    long_line every later copy of a line of more words than that goes too, whatever stands around it. A run
    whose chosen gram came first in another context is only sure to go as a whole with contexts.
    """
    own = texts(docs, id_col, text_col, carry)
    runs = repeated_runs(own, gram, window, contexts=contexts)
    if long_line is not None:
        runs = runs.union(repeated_lines(own, long_line))
    # Distinct first, in tasks and then by line: rows that repeat a document a million times are one by the time its lines meet.
    one = runs.select("doc_id", "tag", F.explode("gone").alias("i")).distinct()
    # A byte for each line up to the last that goes, so that each line is looked up in one step.
    places = one.groupBy("doc_id", "tag").agg(F.array_sort(F.collect_list("i")).alias("gone"))
    mask = "cast(array_join(transform(gone, (g, k) -> concat(repeat('0', g - if(k = 0, -1, gone[k - 1]) - 1), '1')), '') as binary)"
    places = places.select("doc_id", "tag", F.expr(mask).alias("mask"), F.size("gone").cast("long").alias("n"))
    # Places are a column of the join and the lines an argument: neither is computed again for each line.
    cut = own.withColumn("tag", F.xxhash64("text")).join(places, ["doc_id", "tag"], "left")
    lines = r"split(text, '\n', -1)"
    return cut.select(
        "doc_id", *(["carried"] if "carried" in own.columns else []),
        F.expr(rf"if(mask is null, text, array_join(filter({lines}, (x, i) -> substring(mask, i + 1, 1) <> X'31'), '\n'))").alias("text"),
        F.expr(f"if(text is null or text = '', 0L, cast(size({lines}) as bigint))").alias("n_lines"), F.coalesce("n", F.lit(0).cast("long")).alias("n_removed"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document and how many go: all of every run of three lines that occurred before and every later copy of a line of
    over 50 words, besides the pairs of lines that the windows choose; see dedup_lines() for odd rows."""
    out = dedup_lines(table(spark, sf_dir, "documents"), long_line=LONG, contexts=True)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))
