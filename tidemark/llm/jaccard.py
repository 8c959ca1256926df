"""N-gram Jaccard join: blocked sparse products of a document by shingle incidence."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Seen, rows_of, spent, table, texts, written
from .components import connected_components

#: Shingles of N words; similarity of LINK per cent or more; documents in a block, and shingles of them all.
N, LINK, BLOCK, BLOCK_SHINGLES = 4, 85, 1024, 1 << 18
#: Dealings of a set over parts, until one leaves few parts empty.
DEALS = 32
#: Keys that a task gathers before it deals them over buckets, and keys of a bucket.
GATHERED, BUCKET = 1 << 19, 1 << 19
_MUL = np.uint64(0x9E3779B97F4A7C15)
_LOG = 1_000_000_000


class Shingles:
    """Sorted 64-bit hashes of a text's distinct shingles."""

    def __init__(self, n: int):
        self.n, self.seen, self.hashes = n, Seen(), np.zeros(1 << 12, np.uint64)

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode().lower().split() if text else []
        if not words:
            return np.zeros(0, np.uint64)
        seen = self.seen
        new, at = seen.missing(words), len(seen)
        if new:
            while at + len(new) > len(self.hashes):
                self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)])
            self.hashes[at : at + len(new)] = [xxhash.xxh3_64_intdigest(w) for w in new]
            seen.update(zip(new, range(at, at + len(new)), strict=True))
        h = self.hashes[np.fromiter(map(seen.__getitem__, words), np.int64, len(words))]
        k = min(self.n, len(h))
        out = h[: len(h) - k + 1].copy()
        for i in range(1, k):
            out = mixed(out * _MUL + h[i : len(h) - k + 1 + i])
        return np.unique(mixed(out + np.uint64(k)))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Classes:
    """Classes of set sizes such that two sets that link are in one class or in neighbours, and for each class k the number
    of parts, most + 1 and some to spare, where most is the largest symmetric difference of sets that link whose smaller one
    is in class k. Of so many parts of the shingles one at least is equal in both sets."""

    def __init__(self, link: int):
        self.link, self.low, self.parts, self.most = link, [1], [], []

    def at(self, size: int) -> int:
        while self.low[-1] <= size:
            # The largest size that links with the first of the class begins the next one at the soonest.
            self.low.append(self.low[-1] * 100 // self.link + 1)
        k = int(np.searchsorted(self.low, size, side="right")) - 1
        while len(self.parts) <= k:
            a = self.low[len(self.parts) + 1] - 1 if len(self.low) > len(self.parts) + 1 else self.low[-1] * 100 // self.link
            both = a + a * 100 // self.link
            self.most.append(both * (100 - self.link) // (100 + self.link))
            # A twentieth of the parts of the smallest sets of a class may be empty.
            self.parts.append(self.most[-1] + 2 + self.most[-1] // 8)
        return k


def keys(own: np.ndarray, classes: Classes) -> tuple[np.ndarray, bytes]:
    """A 64-bit key for each part of the set that isn't empty, in its size's class and in the one below, where it can be the
    larger one. And a byte of each part's digest, for the one class and then the other.

    With more than `most` full parts, one of the parts that are equal in a linked set is full. A set with fewer has the keys of
    another dealing too, and so on up to its first good one: of two sets that link both have the keys of the earlier one's. Empty
    parts, which sets without anything in common share, are keys only where no dealing is good."""
    k = classes.at(len(own))
    out, outline = [], b""
    digest = mixed(own ^ np.uint64(0x5851F42D4C957F2D))
    for c in (k, k - 1):
        if c < 0:
            continue
        parts, most = classes.parts[c], classes.most[c]
        for deal in range(DEALS):
            part = (((mixed(own + np.uint64(deal * int(_MUL) % (1 << 64))) if deal else own) >> np.uint64(11)) % np.uint64(parts)).astype(np.int64)
            full = np.bincount(part, minlength=parts) > 0
            good = full.sum() > most
            # The sum of mixed hashes is the digest of a part's set.
            total = np.zeros(parts, np.uint64)
            np.add.at(total, part, digest)
            if not deal:
                outline += (mixed(total) >> np.uint64(56)).astype(np.uint8).tobytes()
            use = np.flatnonzero(full) if good or deal < DEALS - 1 else np.arange(parts)
            out.append(mixed(total[use] * _MUL + mixed(use.astype(np.uint64) * np.uint64(2654435761) + np.uint64((c << 40) + (deal << 56)))))
            if good:
                break
    return np.concatenate(out), outline


def sets_of(docs: DataFrame, n: int, link: int) -> DataFrame:
    """doc_id, size and digest of the set in two longs, for every row; its keys and their number, and its outline, as bytes."""
    kinds = {"doc_id": pa.int64(), "n_shingles": pa.int64(), "d1": pa.int64(), "d2": pa.int64(), "outline": pa.binary(), "n_keys": pa.int64(), "keys": pa.binary()}

    def run(batches):
        make, classes, schema = Shingles(n), Classes(link), pa.schema(list(kinds.items()))
        for batch in batches:
            for part in rows_of(batch):
                rows: dict = {name: [] for name in kinds}
                for i, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    own = make(text)
                    d = xxhash.xxh3_128_digest(own.tobytes()) if len(own) else bytes(16)
                    k, outline = keys(own, classes) if len(own) and i is not None else (own[:0], b"")
                    for name, v in zip(rows, (i, len(own), int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True), outline, len(k), k.tobytes()), strict=True):
                        rows[name].append(v)
                yield pa.RecordBatch.from_pydict(rows, schema=schema)

    return docs.mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long, outline binary, n_keys long, keys binary")


def lowest(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the first of each different key, the lowest node of each key, and as rows (key, node, lowest node of the key)
    where the two nodes differ."""
    order = np.argsort(key, kind="stable")
    start = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
    low = np.minimum.reduceat(node[order], start)
    met = np.column_stack([key[order].view(np.int64), node[order], np.repeat(low, np.diff(np.append(start, len(key))))])
    return order[start], low, met[met[:, 1] != met[:, 2]]


def shared_keys(units: DataFrame, buckets: int) -> DataFrame:
    """(key, node, low): every node that isn't the lowest one of a key that it has, with the key and a lower node that has it,
    such that all nodes of a key hang together. units: node and its keys, as bytes.

    A task deals the keys that it gathers over buckets, each key once with its lowest node; one row of bytes is a bucket's share.
    A key that many nodes have is so one entry for each GATHERED keys, not a hot group. 48 bits of a key travel besides its
    bucket: a chance match can only add a candidate."""
    kinds = {"bucket": pa.int32(), "keys": pa.binary(), "nodes": pa.binary(), "met": pa.binary()}

    def deal(batches):
        held: list = []

        def out():
            key, node = (np.concatenate(x) for x in zip(*held, strict=True))
            first, low, met = lowest(key, node)
            # In the order of arrival a node's keys stand together, which keeps their equal nodes short when compressed.
            back = np.argsort(first)
            key, low = key[first[back]], low[back]
            bucket = ((key >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            key, low, bucket = key[by], low[by], bucket[by]
            cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])).tolist()
            short = key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
            share = [np.ascontiguousarray(x) for x in np.array_split(met, len(cut) - 1)]
            rows = {
                "bucket": bucket[cut[:-1]], "keys": [short[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)], "nodes": [low[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)],
                "met": [x.tobytes() for x in share],
            }
            held.clear()
            return pa.RecordBatch.from_pydict(rows, schema=pa.schema(list(kinds.items())))

        n = 0
        for batch in batches:
            for i, raw in zip(batch.column("node").to_pylist(), batch.column("keys").to_pylist(), strict=True):
                held.append((np.frombuffer(raw, np.uint64), np.full(len(raw) // 8, i, np.int64)))
                n += len(raw) // 8
                if n >= GATHERED:
                    yield out()
                    n = 0
        if n:
            yield out()

    def meet(bucket, own):
        raw = {name: b"".join(own.column(name).to_pylist()) for name in ("keys", "nodes", "met")}
        key = np.zeros((len(raw["keys"]) // 6, 8), np.uint8)
        key[:, :6] = np.frombuffer(raw["keys"], np.uint8).reshape(-1, 6)
        # A key's name is the bucket and the 48 bits, mixed; keys that met within a task come whole and get the same name.
        low48, at = np.uint64((1 << 48) - 1), np.uint64(40)
        name = lambda k, b: mixed((k & low48) * _MUL + b)
        _, _, across = lowest(name(key.view("<u8").ravel(), np.uint64(bucket[0].as_py())), np.frombuffer(raw["nodes"], np.int64))
        within = np.frombuffer(raw["met"], np.int64).reshape(-1, 3).copy()
        whole = within[:, 0].view(np.uint64)
        within[:, 0] = name(whole, (whole >> at) % np.uint64(buckets)).view(np.int64)
        both = np.concatenate([across, within])
        return pa.table({c: pa.array(both[:, i]) for i, c in enumerate(("key", "node", "low"))})

    return units.select("node", "keys").mapInArrow(deal, "bucket int, keys binary, nodes binary, met binary").groupBy("bucket").applyInArrow(meet, "key long, node long, low long")


def outlines_allow(link: int, a: np.ndarray, size: int, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether sets may link: each part that differs is a difference of the sets, and those are bounded by the sizes."""
    return (others != a).sum(axis=1) * (100 + link) <= (sizes + size) * (100 - link)


def outline_in(classes: Classes, outline: bytes, size: int, c: int) -> np.ndarray:
    """The outline's bytes for class c, the set's own or the one below."""
    own = classes.parts[classes.at(size)]
    return np.frombuffer(outline, np.uint8)[:own] if classes.at(size) == c else np.frombuffer(outline, np.uint8)[own:]


def likely_pairs(pairs: DataFrame, link: int) -> DataFrame:
    """The pairs (node, low, each with its outline and size) whose outlines allow a link."""

    def run(batches):
        classes = Classes(link)
        for batch in batches:
            keep = []
            for o1, s1, o2, s2 in zip(*(batch.column(c).to_pylist() for c in ("o1", "s1", "o2", "s2")), strict=True):
                k, c = classes.at(s1), classes.at(s2)
                ok = abs(k - c) < 2 and outlines_allow(link, outline_in(classes, o1, s1, min(k, c)), s1, outline_in(classes, o2, s2, min(k, c))[None], np.array([s2]))[0]
                keep.append(bool(ok))
            yield batch.select(["node", "low"]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(run, "node long, low long")


def comparable(classes: Classes, sizes: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Places of the sizes that lie in one class or in two neighbours, with the lower class. The nodes of a key do, but for those
    that a chance match adds, which may be of any size; sets that lie further apart don't link."""
    at = np.array([classes.at(s) for s in sizes.tolist()])
    have = set(at.tolist())
    return [(c, np.flatnonzero((at == c) | (at == c + 1))) for c in sorted(have) if c - 1 not in have or c + 1 in have]


def likely_in_blocks(packs: DataFrame, link: int) -> DataFrame:
    """A forest of the pairs, of nodes of different components `part`, whose outlines allow a link, for each key (or each two
    blocks of a key's nodes) of a pack."""

    def run(own):
        classes = Classes(link)
        own = own.sort_by("key")
        key, b1, b2, node, part, size, side = (own.column(c).to_numpy() for c in ("key", "b1", "b2", "node", "part", "size", "side"))
        outline = own.column("outline").to_pylist()
        cut = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        u, v = [], []
        for a, b in zip(cut, cut[1:], strict=False):
            first = b1[a] == b2[a]
            for c, among in comparable(classes, size[a:b]):
                among = among + a
                own_size, own_side = size[among], side[among]
                lines = np.array([outline_in(classes, outline[k], int(size[k]), c) for k in among.tolist()])
                root = np.unique(part[among], return_inverse=True)[1]
                for i in range(len(among)):
                    other = np.flatnonzero(root != root[i])
                    other = other[other > i] if first else other[(own_side[other] == 1) & (own_side[i] == 0)]
                    if not len(other):
                        continue
                    for j in other[outlines_allow(link, lines[i], own_size[i], lines[other], own_size[other])].tolist():
                        if root[i] != root[j]:
                            root[root == root[j]] = root[i]
                            u.append(int(node[among[i]]))
                            v.append(int(node[among[j]]))
        return pa.table({"node": pa.array(u, pa.int64()), "low": pa.array(v, pa.int64())})

    return packs.groupBy("pack").applyInArrow(run, "node long, low long")


def candidate_groups(units: DataFrame, n_keys: int, link: int, block: int = BLOCK) -> DataFrame:
    """(node, component): components of the pairs of sets that share a key and whose outlines allow a link. units: node, size,
    keys, outline; the rows of equal sets are equal.

    First each node is held against one other node of each of its keys, which joins near copies in one step. Then the keys whose
    nodes aren't all in one component by that, once for keys of the same nodes, have all their nodes compared, in blocks."""
    met = written(shared_keys(units, min(n_keys // BUCKET + 1, 1 << 24)), "shared")
    some = met.select("node").union(met.select("low")).distinct()
    lines = written(units.select("node", "size", "outline").join(some, "node", "left_semi").dropDuplicates(["node"]), "outlines")
    one, two = (lines.select(F.col("node").alias(c), F.col("outline").alias(f"o{i}"), F.col("size").alias(f"s{i}")) for i, c in ((1, "node"), (2, "low")))
    direct = written(likely_pairs(met.select("node", "low").distinct().join(one, "node").join(two, "low"), link), "likely")
    parts = connected_components(direct)
    entry = met.select("key", "node").union(met.select("key", F.col("low").alias("node"))).distinct().join(parts, "node", "left").select("key", "node", F.coalesce("component", "node").alias("part"))
    entry = written(entry, "entries")
    # A key of two nodes had its pair compared already.
    open_ = entry.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("names"), F.min("part").alias("p"), F.max("part").alias("q")).where("n > 2 and p < q")
    open_ = written(open_.groupBy("names", "n").agg(F.min("key").alias("key")).select("key", "n", F.ceil(F.col("n") / block).alias("blocks")), "open")
    # Small keys share a group, as many as make some blocks; two blocks of a large one are a group.
    packs = open_.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // (4 * block) + 1
    dealt = entry.join(open_, "key").join(lines, "node").withColumn("b", F.pmod(F.xxhash64("node"), F.col("blocks"))).withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"b1": F.least("b", "o"), "b2": F.greatest("b", "o"), "side": F.when(F.col("b") <= F.col("o"), 0).otherwise(1)})
    pack = F.when(F.col("blocks") == 1, F.concat(F.lit("s"), F.pmod(F.xxhash64("key"), F.lit(packs)))).otherwise(F.concat_ws("/", "key", "b1", "b2"))
    rest = written(likely_in_blocks(dealt.select(pack.alias("pack"), "key", "b1", "b2", "side", "node", "part", "size", "outline"), link), "likely")
    out = connected_components(direct.union(rest))
    spent(met, lines, direct, parts, entry, open_, rest)
    return out


def with_sets(docs: DataFrame, n: int) -> DataFrame:
    """doc_id and the set's hashes as bytes."""

    def run(batches):
        make = Shingles(n)
        for batch in batches:
            for part in rows_of(batch):
                own = [make(t).tobytes() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "set": pa.array(own, pa.binary())}, schema=pa.schema([("doc_id", pa.int64()), ("set", pa.binary())]))

    return docs.mapInArrow(run, "doc_id long, set binary")


def product_links(blocks: DataFrame, link: int) -> DataFrame:
    """A forest of the links within each two blocks of a group of candidates, from the sparse product of their incidence. Sets of
    one component (`part`) are known to hang together.

    Overlaps are added up for one document at a time over the columns it shares with others; pairs whose sizes alone rule the
    similarity out don't link, and a document whose possible partners all hang together with it has no product. So a group of
    near copies costs one row of the product, not all. What a task returns is less than one row for each document."""

    def run(key, own):
        first = key[1].as_py() == key[2].as_py()
        own = own.sort_by("doc_id")
        ids, side, part = (own.column(c).to_numpy() for c in ("doc_id", "side", "part"))
        sets = [np.frombuffer(x, np.uint64) for x in own.column("set").to_pylist()]
        size = np.array([len(s) for s in sets])
        # Columns: shingles of two documents or more; postings hold each column's documents.
        doc = np.repeat(np.arange(len(sets)), size)
        column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
        keep = count[column] > 1
        doc, column = doc[keep], column[keep]
        by = np.argsort(column, kind="stable")
        postings = doc[by]
        start = np.concatenate([[0], np.cumsum(np.bincount(column, minlength=len(count)))])
        at = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(sets)))])
        root = np.unique(part, return_inverse=True)[1]
        u, v = [], []
        for i in range(len(sets)):
            if not first and side[i]:
                continue
            near = (root != root[i]) & (np.minimum(size, size[i]) * 100 >= link * np.maximum(size, size[i]))
            near &= np.arange(len(sets)) > i if first else side == 1
            mine = column[at[i] : at[i + 1]]
            if not len(mine) or not near.any():
                continue
            lengths = start[mine + 1] - start[mine]
            where = np.repeat(start[mine] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
            overlap = np.bincount(postings[where], minlength=len(sets))
            near &= overlap * (100 + link) >= link * (size + size[i])
            for j in np.flatnonzero(near).tolist():
                if root[i] != root[j]:
                    root[root == root[j]] = root[i]
                    u.append(int(ids[i]))
                    v.append(int(ids[j]))
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return blocks.groupBy("group", "b1", "b2").applyInArrow(run, "u long, v long")


def near_documents(docs: DataFrame, n: int = N, link: int = LINK, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id (the smallest doc_id that links reach).

    Documents link when 100 * intersection >= link * union of their n-word shingle sets. All links count, none is sampled:
    1. Documents with equal sets become one, the lowest id (partial minima, so thousands of copies are no hot group).
    2. Shingles are dealt over parts, as many as the size allows differences; sets that link have an equal part. Sets that share
       a part, and whose other parts don't differ too often for a link, are candidates; groups of them are components.
    3. Each group, in blocks of documents in the order of size, is multiplied with itself: each block with itself, then pairs of
       blocks for what doesn't hang together yet; a document only meets blocks whose sizes allow a link. Only a forest of the
       true links leaves a task, never all pairs.
    4. Components of those links.
    Null, empty and blank texts have no shingles and link with nothing, neither do null ids (component null). Rows that share
    an id are one node: each of their texts links. Other columns are ignored.
    """
    own = texts(docs, id_col, text_col)
    made = written(sets_of(own, n, link), "sets")
    rows = written(made.select("doc_id", "n_shingles", "d1", "d2"), "sizes")
    full = rows.where("n_shingles > 0 and doc_id is not null")
    same = written(full.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("size")), "same")
    # Equal sets are one node. An id with several texts has a node for each of them.
    unit = made.where("n_keys > 0").select(F.xxhash64("d1", "d2").alias("node"), F.col("n_shingles").alias("size"), "keys", "outline")
    groups = candidate_groups(unit, made.agg(F.coalesce(F.sum("n_keys"), F.lit(0))).first()[0], link)
    spent(made)
    member = same.withColumn("node", F.xxhash64("d1", "d2")).join(groups.withColumnRenamed("component", "group"), "node")
    # The place of a document in its group by size; groups are counted in parts, for a window would take one to one task.
    member = written(placed(member, block, link).withColumnRenamed("rep", "doc_id"), "members")

    def linked(rows: DataFrame, others) -> DataFrame:
        """Links of rows of `member` with `part`, each with the blocks that `others` names."""
        sets = with_sets(own.join(rows.select("doc_id").distinct(), "doc_id", "left_semi"), n)
        # One shuffle of the sets serves both the repeated rows and the join.
        sets = sets.withColumn("digest", F.xxhash64("set")).repartition("doc_id").dropDuplicates(["doc_id", "digest"]).drop("digest")
        met = rows.join(sets, "doc_id").where(F.length("set") == F.col("size") * 8).withColumn("o", F.explode(others))
        both = met.select("group", F.least("b", "o").alias("b1"), F.greatest("b", "o").alias("b2"), F.when(F.col("b") <= F.col("o"), 0).otherwise(1).alias("side"), "doc_id", "part", "set")
        return written(product_links(both, link), "links")

    # Each block with itself first. What hangs together by that has no product any more where blocks meet.
    links = linked(member.withColumn("part", F.col("doc_id")), F.array("b"))
    wide = member.where("from < to")
    if not wide.isEmpty():
        near = connected_components(links)
        rows_of_wide = written(wide.join(near.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("part", F.coalesce("component", "doc_id")).drop("component"), "wide")
        links = links.union(linked(rows_of_wide, F.array_remove(F.sequence("from", "to"), F.col("b"))))
    # Copies take their representative's component. An id with several different sets ties those together.
    ties = full.join(same.select("d1", "d2", "rep"), ["d1", "d2"]).select("doc_id", "rep").distinct()
    ties = ties.join(ties.groupBy("doc_id").agg(F.min("rep").alias("least")), "doc_id").where("rep <> least").select("least", "rep")
    parts = connected_components(links.union(ties))
    known = written(same.join(parts, same.rep == parts.node, "left").select("d1", "d2", F.coalesce("component", "rep").alias("component_id")), "known")
    spent(groups, member, parts, same)
    out = rows.join(known, ["d1", "d2"], "left")
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    return out.select("doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def placed(member: DataFrame, block: int, link: int) -> DataFrame:
    """member (group, size, rep) with its block b and the blocks `from`, `to` between which all documents lie whose sizes allow
    a link: blocks of about `block` documents, or BLOCK_SHINGLES shingles where that is fewer, of a group in the order of size.
    A set travels once for each block it meets, so small sets make blocks of many."""
    places = F.ceil(F.col("size") * block / BLOCK_SHINGLES)
    # Cumulated over the distinct sizes of a group, not over its documents.
    sizes = member.groupBy("group", "size").agg(F.count("*").alias("n")).withColumn("places", F.col("n") * places)
    by_size = Window.partitionBy("group").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    sizes = sizes.withColumn("end", F.sum("places").over(by_size)).withColumn("before", F.col("end") - F.col("places"))
    # Sizes that allow a link are a range of logarithms, here whole numbers with one to spare for rounding.
    far = int(np.log(100 / link) * _LOG) + 2
    by_log = Window.partitionBy("group").orderBy("log")
    sizes = sizes.withColumn("log", F.floor(F.log("size") * _LOG))
    sizes = sizes.withColumn("from", F.floor(F.min("before").over(by_log.rangeBetween(-far, 0)) / block)).withColumn("to", F.floor((F.max("end").over(by_log.rangeBetween(0, far)) - 1) / block))
    # Documents of one size are spread over the blocks that the size covers, by hash.
    at = member.join(sizes.drop("places", "end", "log"), ["group", "size"])
    b = F.floor((F.col("before") + F.pmod(F.xxhash64("rep"), F.col("n")) * places) / block)
    return at.withColumn("b", b).select("group", "size", "rep", "b", "from", "to")


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of four-word shingles and the component at 85 per cent of every document; odd rows as in the functions it calls."""
    return near_documents(table(spark, sf_dir, "documents"))
