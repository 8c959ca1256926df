"""Byte-level BPE encoding and decoding in length-bucketed padded numpy matrices."""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache
from pathlib import Path

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import Seen, map_batches, table, texts

RANKS = "byte_bpe_multi_50k.tiktoken"
NONE = np.int64(1 << 40)
#: A match of more bytes is merged with a heap, for a round per merge would take the square of its length. Same result.
LONG = 1024
CELLS, MOST_RANK_BYTES = 1 << 18, 64 << 20


class BytePairs:
    """Merges by rank. A pair of ids is looked up in an open-addressing table; all splits of each token are in it."""

    def __init__(self, blob: bytes):
        self.rank = {base64.b64decode(a): int(b) for a, b in (x.split() for x in blob.splitlines() if x.strip())}
        self.token = {v: k for k, v in self.rank.items()}
        self.of_byte = np.array([self.rank[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {
            (self.rank[t[:i]] << 32) | self.rank[t[i:]]: r
            for t, r in self.rank.items()
            for i in range(1, len(t))
            if t[:i] in self.rank and t[i:] in self.rank
        }
        self.pairs = pairs
        keys, new = np.fromiter(pairs, np.uint64, len(pairs)), np.fromiter(pairs.values(), np.int64, len(pairs))
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys, self.new = np.full(1 << self.bits, ~np.uint64(0)), np.full(1 << self.bits, NONE)
        slot, left, self.probes = self._slot(keys), np.arange(len(keys)), 0
        while len(left):
            at = (slot[left] + self.probes) & ((1 << self.bits) - 1)
            free = self.new[at] == NONE
            self.keys[at[free]], self.new[at[free]] = keys[left[free]], new[left[free]]
            left = left[self.keys[at] != keys[left]]
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id, which is also the rank, that each pair becomes; NONE where it is no pair or a side is padding (< 0)."""
        out = np.full(left.shape, NONE)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        key = (left.ravel()[at].astype(np.uint64) << np.uint64(32)) | right.ravel()[at].astype(np.uint64)
        slot, flat = self._slot(key), out.ravel()
        for probe in range(self.probes):
            s = (slot + probe) & ((1 << self.bits) - 1)
            hit = self.keys[s] == key
            flat[at[hit]] = self.new[s[hit]]
            more = ~hit & (self.new[s] != NONE)
            if not more.any():
                break
            at, key, slot = at[more], key[more], slot[more]
        return flat.reshape(left.shape)

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        wait = []
        for i, p in enumerate(pieces):
            if (r := self.rank.get(p)) is not None:
                out[i] = r.to_bytes(4, "little")
            elif len(p) > LONG:
                out[i] = self._long(p)
            elif p:
                wait.append(i)
        wait.sort(key=lambda i: len(pieces[i]))
        at = 0
        while at < len(wait):  # rows of about the same length, in matrices of a bounded number of cells
            end, short = at, len(pieces[wait[at]])
            while end < len(wait) and len(pieces[wait[end]]) <= short + short // 4 and (end - at) * len(pieces[wait[end]]) < CELLS:
                end += 1
            self._matrix([pieces[i] for i in wait[at:end]], wait[at:end], out)
            at = end
        return out

    def _matrix(self, pieces: list[bytes], places: list[int], out: list[bytes]) -> None:
        size = np.array([len(p) for p in pieces])
        ids = np.full((len(pieces), size.max() + 1), -1, dtype=np.int64)
        ids[np.arange(ids.shape[1]) < size[:, None]] = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        rank, place = self.merged(ids[:, :-1], ids[:, 1:]), np.array(places)
        while len(ids):
            pos = rank.argmin(axis=1)  # the leftmost of the lowest
            rows = np.arange(len(ids))
            best = rank[rows, pos]
            if (done := best == NONE).any():
                for i in np.flatnonzero(done):
                    out[place[i]] = ids[i][ids[i] >= 0].astype("<u4").tobytes()
                keep = ~done
                ids, rank, place, pos, best = ids[keep], rank[keep], place[keep], pos[keep], best[keep]
                rows = np.arange(len(ids))
                if not len(ids):
                    return
            ids[rows, pos] = best
            col = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, col + (col > pos[:, None]), axis=1)
            col = np.arange(ids.shape[1] - 1)
            rank = np.take_along_axis(rank, col + (col >= pos[:, None]), axis=1)
            inside = pos < ids.shape[1] - 1
            rank[rows[inside], pos[inside]] = self.merged(ids[rows[inside], pos[inside]], ids[rows[inside], pos[inside] + 1])
            inside = pos > 0
            rank[rows[inside], pos[inside] - 1] = self.merged(ids[rows[inside], pos[inside] - 1], ids[rows[inside], pos[inside]])

    def _long(self, piece: bytes) -> bytes:
        ids = self.of_byte[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        get, end = self.pairs.get, len(ids)
        heap = [(r, i) for i in range(end - 1) if (r := get((ids[i] << 32) | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if ids[i] < 0 or (j := after[i]) >= end or get((ids[i] << 32) | ids[j]) != r:
                continue
            ids[i], ids[j], after[i] = r, -1, after[j]
            if after[j] < end:
                before[after[j]] = i
                if (x := get((r << 32) | ids[after[j]])) is not None:
                    heapq.heappush(heap, (x, i))
            if (b := before[i]) >= 0 and (x := get((ids[b] << 32) | r)) is not None:
                heapq.heappush(heap, (x, b))
        return np.array([i for i in ids if i >= 0], dtype="<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def pairs_of(blob: bytes) -> BytePairs:
    return BytePairs(blob)


def rank_blob(path: str) -> bytes:
    """The rank file's bytes, read by the driver for the executors. Its size is checked, for it is sent to every task."""
    blob = Path(path).read_bytes()
    if len(blob) > MOST_RANK_BYTES:
        raise ValueError(f"{path}: more than {MOST_RANK_BYTES} bytes of ranks")
    return blob


def encode(docs: DataFrame, ranks_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """One row for each row of docs: doc_id, n_tokens, ids (array of int, if keep_ids), ids_sha256, decoded_sha256.

    Each match of the pattern is encoded apart. Null and empty texts have no ids, and the digests of no bytes. A repeated row
    gives a repeated result, a null id stays null, other columns are ignored. No shuffle: matches that were seen before in
    the same task come from a cache of bounded size, all new ones of a slice go through the matrices together.
    """
    blob = docs.sparkSession.sparkContext.broadcast(rank_blob(ranks_path or public_tokenizers.path(RANKS)))
    pattern = public_tokenizers.PATTERN

    def make():
        bpe, find, seen = pairs_of(blob.value), regex.compile(pattern).findall, Seen()

        def step(cols):
            found = [find(t) if t else [] for t in cols["text"]]
            new = seen.missing(m for ms in found for m in ms)
            seen.update(zip(new, bpe.encode([m.encode() for m in new]), strict=True))
            ids = [b"".join(map(seen.__getitem__, ms)) for ms in found]
            out = {
                "doc_id": cols["doc_id"],
                "n_tokens": [len(x) // 4 for x in ids],
                "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids],
            }
            if keep_ids:
                out["ids"] = [np.frombuffer(x, "<u4").astype(np.int32) for x in ids]
            yield out

        return step

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if keep_ids else "")
    return map_batches(texts(docs, id_col, text_col), make, schema)


def decode(tokens: DataFrame, ranks_path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text (the ids' bytes as UTF-8, malformed bytes replaced) of each row; null ids give an empty text."""
    blob = tokens.sparkSession.sparkContext.broadcast(rank_blob(ranks_path or public_tokenizers.path(RANKS)))

    def make():
        bpe = pairs_of(blob.value)

        def step(cols):
            yield {"doc_id": cols["doc_id"], "text": [bpe.decode(np.array(x or [], "<u4").tobytes()).decode("utf-8", "replace") for x in cols["ids"]]}

        return step

    own = tokens.select(tokens[id_col].cast("long").alias("doc_id"), tokens[ids_col].cast("array<int>").alias("ids"))
    return map_batches(own, make, "doc_id long, text string")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded bytes of every document; odd rows as in the functions it calls."""
    return encode(table(spark, sf_dir, "documents"), keep_ids=False)
