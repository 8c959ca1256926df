"""Mixing sources to target weights: van der Corput slots through cumulative weights, ranked per source, joined to blocks of equal
length of each source's shuffled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.identities import numbered
from .common import table, written

#: Weights in turn, the mix's share of all words, how often a source's words repeat at most, words of a block, and the shuffle's seed.
WEIGHTS, SHARE, REPEAT, BLOCK, SEED = (5, 2, 1), 1.5, 2, 1024, 13
#: Positions that meet their source together, slots that are ranked in one go, and parts that a source's documents are put in order by.
RUN, STRETCH, PARTS = 1 << 6, 1 << 14, 1 << 10
WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """row, doc_id, source, size and h, a hash of the id that is a document's place in the shuffle. row is a name within one stored table."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed).cast("string"), docs[id_col].cast("string")).cast("binary")), 1, 15), 16, 10).cast("long")
    size = F.coalesce(F.regexp_count(docs[text_col].cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[source_col].cast("string").alias("source"), size.alias("size"), h.alias("h")).withColumn("row", F.monotonically_increasing_id())


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeat: int = REPEAT) -> DataFrame:
    """source, source_size, weight, target (words) and want (target in whole words) from rows of source and size.

    Sources in the order of their code points, null last, take the weights in turn. `share` of all words is dealt by weight; a
    source stops at `repeat` times its own words, and what it leaves is dealt to the others by weight, until none is above. Each
    round of that is one sum over the sources."""
    own = written(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    named = numbered(own.where("source is not null"), "source", "n")
    unnamed = own.where("source is null").withColumn("n", F.lit(own.where("source is not null").count() + 1).cast("long"))
    turn = F.array(*map(F.lit, weights))
    own = written(named.unionByName(unnamed).withColumn("weight", F.element_at(turn, (F.pmod(F.col("n") - 1, F.lit(len(weights))) + 1).cast("int")).cast("long")), "weights")
    cap = F.col("source_size") * repeat
    words = own.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    full = F.lit(False)
    rest, among, held = share * words, None, -1
    while True:
        # What full sources hold, and the weight of the others: the full ones only become more, so this ends.
        n, spent, among = own.agg(F.count_if(full), F.coalesce(F.sum(F.when(full, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0))).first()
        if n == held or not among:
            break
        held, rest = n, share * words - spent
        full = F.col("weight") * F.lit(rest) / F.lit(among) >= cap
    target = F.when(full, cap.cast("double")).otherwise(F.col("weight") * F.lit(rest) / F.lit(among)) if among else cap.cast("double")
    return own.select("source", "source_size", "weight", target.alias("target")).withColumn("want", F.floor(F.col("target") + 0.5))


def slots_of(size: Column, want: Column, block: int) -> Column:
    """Slots that a source of `size` words takes for `want` of them: all of its blocks for every whole turn, and those that the rest reaches."""
    rest = F.pmod(want, size)
    return (F.floor(want / size) * F.ceil(size / F.lit(block)) + F.ceil(rest / F.lit(block))).cast("long")


def schedule(goal: DataFrame, block: int = BLOCK) -> DataFrame:
    """slot, source, rank, turn, block_no, words: the order in which the mix takes blocks. goal: targets().

    Slot k stands at the van der Corput point of k, its binary digits reversed, as a share of a power of two; the sources' slots
    are laid side by side in proportion, and the point says whose slot k is. Digits of m bits reverse one to one, so
    every source gets exactly its slots, and any stretch of the schedule holds about its share of them. A slot's rank among
    those of its source says which block it takes: the source's blocks in turn, and again from the first once all are through. The
    last slot is as long as the target still asks for."""
    lay = goal.where("want > 0").select("source", "source_size", "want", slots_of(F.col("source_size"), F.col("want"), block).alias("n_slots"))
    # Laid in the order of a hash by parts, so that no task sees all sources.
    part = F.pmod(F.xxhash64("source"), F.lit(PARTS))
    lay = lay.withColumn("part", part)
    before = lay.groupBy("part").agg(F.sum("n_slots").alias("s")).select("part", _ahead("s", [], ["part"]).alias("before"))
    laid = written(lay.withColumn("inner", _ahead("n_slots", ["part"], ["source"])).join(before, "part").select("source", "source_size", "want", "n_slots", (F.col("before") + F.col("inner")).alias("low")), "laid")
    k = laid.agg(F.coalesce(F.sum("n_slots"), F.lit(0))).first()[0]
    bits = max(1, (max(k, 1) - 1).bit_length())
    point = F.conv(F.reverse(F.lpad(F.bin("slot"), bits, "0")), 2, 10).cast("long")
    points = laid.sparkSession.range(1 << bits).withColumnRenamed("id", "slot").withColumn("point", point).where(F.col("point") < k)
    # A source meets the points of the runs of positions that its slots touch; a run holds RUN points whoever owns them.
    spread = laid.withColumn("run", F.explode(F.sequence(F.floor(F.col("low") / RUN), F.floor((F.col("low") + F.col("n_slots") - 1) / RUN))))
    at = points.withColumn("run", F.floor(F.col("point") / RUN)).join(spread, "run").where("point >= low and point < low + n_slots")
    # Ranks within stretches of the schedule, after the source's slots in the stretches before: no task sees all slots of a source.
    at = at.withColumn("stretch", F.floor(F.col("slot") / STRETCH)).select("slot", "stretch", "source", "source_size", "want")
    at = written(at, "slots")
    count = at.groupBy("source", "stretch").agg(F.count("*").alias("c"))
    earlier = count.select("source", "stretch", _ahead("c", ["source"], ["stretch"]).alias("earlier"))
    within = at.withColumn("within", F.row_number().over(Window.partitionBy("source", "stretch").orderBy("slot")) - 1)
    ranked = joined(within, earlier, ["source", "stretch"]).withColumn("rank", F.col("within") + F.col("earlier"))
    blocks = F.ceil(F.col("source_size") / F.lit(block))
    out = ranked.select("slot", "source", "rank", F.floor(F.col("rank") / blocks).alias("turn"), F.pmod(F.col("rank"), blocks).alias("block_no"), "source_size", "want")
    start = F.col("block_no") * block
    length = F.least(F.lit(block), F.col("source_size") - start, F.col("want") - F.col("turn") * F.col("source_size") - start)
    return out.select("slot", "source", "rank", "turn", "block_no", length.cast("long").alias("words"))


def placed(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """row, doc_id, source, block_no, at, first, words: which words of which row make up a source's blocks. A row of sized() spans from
    its first word on as many blocks as it reaches; at is where the piece begins in the block.

    Rows stand in the order of their hash, then id, size and place. A source is cut in parts by the hash and equal rows in cells,
    the stored table's partitions; sums of the parts and cells come first, so neither a source that holds most rows nor an id that
    is repeated without end is a hot task. Which of several equal rows is which doesn't matter."""
    key = ["source", "h", "doc_id", "size", "cell"]
    rows = rows.where("size > 0").withColumn("cell", F.floor(F.col("row") / F.lit(1 << 33)))
    nth = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*key).orderBy("row")) - 1)
    entry = rows.groupBy(*key).agg((F.count("*") * F.first("size")).alias("s")).withColumn("part", F.floor(F.col("h") / F.lit((1 << 60) // PARTS)))
    part = entry.groupBy("source", "part").agg(F.sum("s").alias("s"))
    before = part.select("source", "part", _ahead("s", ["source"], ["part"]).alias("before"))
    entry = entry.withColumn("inner", _ahead("s", ["source", "part"], ["h", "doc_id", "size", "cell"]))
    entry = joined(entry, before, ["source", "part"]).select(*key, (F.col("before") + F.col("inner")).alias("offset"))
    own = joined(nth, entry, key).select("row", "doc_id", "source", "size", (F.col("offset") + F.col("nth") * F.col("size")).alias("begin"))
    cut = own.withColumn("block_no", F.explode(F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("begin") + F.col("size") - 1) / block))))
    low, high = F.greatest(F.col("block_no") * block, F.col("begin")), F.least((F.col("block_no") + 1) * block, F.col("begin") + F.col("size"))
    return cut.select("row", "doc_id", "source", "block_no", (low - F.col("block_no") * block).alias("at"), (low - F.col("begin")).alias("first"), (high - low).alias("words"))


def mix(rows: DataFrame, goal: DataFrame, block: int = BLOCK) -> DataFrame:
    """slot, at, source, rank, row, doc_id, first, words: the mix in the order of slot and at, as stretches of documents' words.
    rows: sized(), stored; goal: targets()."""
    order = schedule(goal, block).withColumnRenamed("words", "length")
    pieces = joined(order, placed(rows, block), ["source", "block_no"]).where("at < length")
    return pieces.select("slot", "at", "source", "rank", "row", "doc_id", "first", F.least("words", F.col("length") - F.col("at")).alias("words"))


def with_text(mixed: DataFrame, docs: DataFrame) -> DataFrame:
    """mix() with the words themselves, one blank between them. docs: doc_id, without repeats, and text."""
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    return mixed.join(docs.select("doc_id", "text"), "doc_id").select(*mixed.columns, F.array_join(F.slice(words, (F.col("first") + 1).cast("int"), F.col("words").cast("int")), " ").alias("text"))


def taken(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeat: int = REPEAT, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of docs: its words, its source's words and target, and how many words
    the mix takes of it, repeats counted.

    A source takes its target in whole words exactly. A null text is empty; documents without words are in no block, and a source
    without words has target 0. A null source is a source; null and repeated ids are documents of their own, and equal rows may swap
    what is taken of them. No rows, no result. All numbers follow from ids, sources and sizes, so reruns agree whatever the
    partitions."""
    rows = written(sized(docs, seed=seed), "sized")
    goal = written(targets(rows, weights, share, repeat), "goal")
    total = mix(rows, goal, block).groupBy("row").agg(F.sum("words").alias("taken"))
    out = joined(rows, goal, ["source"]).join(total, "row", "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def _ahead(col: str, by: list[str], order: list[str]) -> Column:
    """The sum of col over what stands before a row."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(col).over(w), F.lit(0))


def joined(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """An inner join in which nulls are equal; the columns of a, then the others of b."""
    b = b.select(*(F.col(c).alias(f"_{c}" if c in on else c) for c in b.columns))
    match = F.lit(True)
    for c in on:
        match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return a.join(b, match).drop(*(f"_{c}" for c in on))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix of all documents takes of each; see taken() for odd rows."""
    return taken(table(spark, sf_dir, "documents"))
