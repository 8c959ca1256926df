"""Near-duplicate vectors: random-hyperplane sign hashing, exact cosines, distributed components."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import rows_of, table, written
from .components import connected_components

#: A pair at the threshold may be missed with probability MISS.
COSINE, MISS, SEED, BLOCK = 0.93, 0.002, 11, 256


def tables_for(rows: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """Bits of a code and number of tables for labels of at most `rows` vectors: four codes for each vector, so that unlike ones
    seldom share one, and as many tables as `miss` takes. Two vectors at the threshold agree in a bit with probability
    1 - arccos(cosine) / pi, which is 0.88 at 0.93: 14 bits and 34 tables up to 4,096 rows, 18 and 59 for 65,536."""
    bits = min(max(14, math.ceil(math.log2(max(rows, 1))) + 2), 30)
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-agree))


def planes(dim: int, bits: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, tables * bits))


def coded(vectors: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """rep, label, vec (doubles as bytes, unit length) and codes (a short for each table, as bytes) of usable vectors."""

    def run(batches):
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            for part in rows_of(batch):
                rows: dict = {"rep": [], "label": [], "vec": [], "codes": []}
                for i, label, v in zip(*(part.column(n).to_pylist() for n in ("rep", "label", "embedding")), strict=True):
                    x = np.array(v, np.float64)
                    # A scale of its own keeps very large and very small vectors from overflow.
                    x = x / np.abs(x).max()
                    x /= np.sqrt(x @ x)
                    if len(x) not in made:
                        made[len(x)] = planes(len(x), bits, tables, seed)
                    code = (x @ made[len(x)] > 0).reshape(tables, bits) @ (1 << np.arange(bits))
                    for n, y in zip(rows, (i, label, x.tobytes(), code.astype("<u4").tobytes()), strict=True):
                        rows[n].append(y)
                yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("rep", pa.int64()), ("label", pa.int64()), ("vec", pa.binary()), ("codes", pa.binary())]))

    return vectors.mapInArrow(run, "rep long, label long, vec binary, codes binary")


def linked_blocks(members: DataFrame, cosine: float) -> DataFrame:
    """For each pack (whole small buckets, or two blocks of a large one): how many links each vector has there (part) and a
    forest of the links (other not null). A pair counts in the first table in which it meets, so in all packs it counts once."""

    def run(own):
        own = own.sort_by([("label", "ascending"), ("t", "ascending"), ("code", "ascending"), ("side", "ascending")])
        table_no = np.array(own.column("t").to_pylist())
        side = np.array(own.column("side").to_pylist())
        rep, copies = (np.array(own.column(c).to_pylist(), np.int64) for c in ("rep", "copies"))
        vec = np.array([np.frombuffer(v) for v in own.column("vec").to_pylist()], dtype=object if len(set(map(len, own.column("vec").to_pylist()))) > 1 else None)
        codes = np.array([np.frombuffer(c, "<u4") for c in own.column("codes").to_pylist()])
        names = list(zip(*(own.column(c).to_pylist() for c in ("label", "t", "code")), strict=True))
        bucket = np.cumsum([0, *(a != b for a, b in zip(names, names[1:], strict=False))])
        links, root = np.zeros(len(rep), np.int64), list(range(len(rep)))
        u, v = [], []

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        def meet(i, j):
            close = np.array([a @ b for a, b in zip(vec[i], vec[j], strict=True)]) if vec.dtype == object else np.einsum("ik,ik->i", vec[i], vec[j])
            keep = close >= cosine
            i, j = i[keep], j[keep]
            before = (codes[i] == codes[j]) & (np.arange(codes.shape[1]) < table_no[i][:, None])
            keep = ~before.any(axis=1)
            i, j = i[keep], j[keep]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                a, b = find(x), find(y)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    u.append(int(rep[x]))
                    v.append(int(rep[y]))

        if side.any():  # two blocks of one bucket, whose vectors are of one length: one product finds what can be close
            one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            at = np.nonzero(np.stack(vec[one]) @ np.stack(vec[two]).T >= cosine - 1e-9)
            meet(one[at[0]], two[at[1]])
        else:  # neighbours at each distance within the sorted buckets
            for lag in range(1, int(np.bincount(bucket).max())):
                i = np.flatnonzero(bucket[lag:] == bucket[:-lag])
                meet(i, i + lag)
        at = np.flatnonzero(links)
        return pa.table({
            "rep": pa.array([*rep[at].tolist(), *u], pa.int64()), "part": pa.array([*links[at].tolist(), *[0] * len(u)], pa.int64()), "other": pa.array([*[None] * len(at), *v], pa.int64()),
        })

    return members.groupBy("pack").applyInArrow(run, "rep long, part long, other long")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, bits: int | None = None, tables: int | None = None, seed: int = SEED, block: int = BLOCK, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row for each row of vectors: vec_id, n_links, component_id, kept.

    Vectors with equal, non-null labels link when the cosine of their doubles is `cosine` or more and they share the code of a
    table. Equal vectors are one to the hashing: they link with each other, and a link to one is a link to all. Null, zero and
    non-finite vectors, and those with null components or an empty array, link with nothing; a vector links only with those of
    its own length. Repeated rows are vectors of their own for n_links. A null id links with nothing. A bucket of any size is
    dealt with in pairs of blocks of `block` vectors; only vectors of buckets that hold two or more travel. Bits and tables
    follow the largest label (tables_for), unless they are given.
    """
    own = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vec_col].cast("array<double>").alias("embedding"), vectors[label_col].cast("long").alias("label"))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    # -0.0 and 0.0 are equal and must have equal digests.
    same = F.sha2(F.array_join(F.transform("embedding", lambda x: (x + F.lit(0.0)).cast("string")), ",").cast("binary"), 256)
    own = written(own.withColumn("same", F.when(F.coalesce(usable, F.lit(False)), same)), "vectors")
    # The lowest id of equal vectors stands for them. Partial minima come first, so a very common vector is no hot group.
    reps = own.where("same is not null").groupBy("label", "same").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    one = written(reps, "reps")
    vec = own.where("same is not null").select("vec_id", "label", "same", "embedding").join(one.select("label", "same", F.col("rep").alias("vec_id"), "copies"), ["vec_id", "label", "same"]).dropDuplicates(["vec_id", "label", "same"])
    # An id that two different vectors share would be one node; a number of its own keeps them apart.
    vec = written(vec.withColumn("node", F.monotonically_increasing_id()), "nodes")
    if bits is None or tables is None:
        bits, tables = tables_for(vec.groupBy("label").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0], cosine)
    codes = written(coded(vec.select(F.col("node").alias("rep"), "label", "embedding"), bits, tables, seed), "codes")
    keyed = codes.select("rep", "label", F.length("vec").alias("len"), F.posexplode(F.expr(f"transform(sequence(0, {tables - 1}), t -> hex(substring(codes, 4 * t + 1, 4)))")).alias("t", "code"))
    keyed = keyed.withColumn("code", F.concat_ws("/", "code", "len"))
    size = written(keyed.groupBy("label", "t", "code").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    # A bucket's vectors are dealt over its blocks by hash; pairs of blocks are groups of at most about two blocks.
    at = keyed.join(size, ["label", "t", "code"]).withColumn("blocks", F.ceil(F.col("size") / block)).withColumn("b", F.pmod(F.xxhash64("rep", "t"), F.col("blocks")))
    at = at.join(codes.select("rep", "vec", "codes"), "rep").join(vec.select(F.col("node").alias("rep"), "copies"), "rep")
    pairs = at.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "label", "t", "code", "blocks", F.least("b", "o").alias("b1"), F.greatest("b", "o").alias("b2"), F.when(F.col("b") <= F.col("o"), 0).otherwise(1).alias("side"), "rep", "copies", "vec", "codes"
    )
    # Small buckets share a group, as many as make about `block` rows; a pair of blocks of a large one is a group.
    packs = max(1, size.where(F.col("size") <= block).agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] // block)
    small = F.pmod(F.xxhash64("label", "t", "code"), F.lit(packs))
    pairs = pairs.withColumn("pack", F.when(F.col("blocks") == 1, F.concat(F.lit("s"), small)).otherwise(F.concat_ws("/", "label", "t", "code", "b1", "b2"))).drop("b1", "b2", "blocks")
    found = written(linked_blocks(pairs, cosine), "links")
    links = found.groupBy("rep").agg(F.sum("part").alias("links"))
    parts = connected_components(found.where("other is not null").select("rep", "other"))
    # Component ids are node numbers; the lowest vec_id of a component's nodes names it.
    nodes = vec.select("node", "vec_id", "label", "same", "copies").join(parts, "node", "left").join(links.withColumnRenamed("rep", "node"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    nodes = written(nodes, "named")
    names = nodes.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    named = nodes.join(names, "component").select("label", "same", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = own.join(named, ["label", "same"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and whether it is kept, for every vector; see near_vectors() for odd rows."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
