"""Helpers that the text operators share."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from ..sources.stored import shared_dir, written  # noqa: F401  (the operators take them from here)

#: ASCII letters lower-cased, every byte that is no digit, letter or part of a non-ASCII character made a blank.
ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


class Seen(dict):
    """What a task keeps of words that it has met. All of it is forgotten when the words are many or, like encoded files, long
    together."""

    most, most_bytes, held = 200_000, 16 << 20, 0

    def missing(self, words) -> list:
        """The words that aren't kept, once each; makes room before, so what is kept now stays until the next call."""
        if len(self) > self.most or self.held > self.most_bytes:
            self.clear()
            self.held = 0
        # Not set.difference: given a subclass of dict, it goes through all that is kept.
        new = [w for w in set(words) if w not in self]
        self.held += sum(map(len, new))
        return new


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spent(*tables: DataFrame) -> None:
    """Deletes written tables. Only for those that nothing reads any more but tables that are themselves written: a task that
    is run again after a lost executor must find its files."""
    for t in tables:
        if at := getattr(t, "stored_at", None):
            path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def given_back() -> None:
    """Memory that a task has freed goes back to the system: Spark keeps its Python workers for the next tasks, and beside each other
    what they once held adds up."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without the call keeps its memory
        ctypes.CDLL(None).malloc_trim(0)


def map_batches(df: DataFrame, make: Callable[[], Callable[[dict], Iterable[dict]]], schema: str | StructType) -> DataFrame:
    """df's Arrow batches through a function from columns (name to list) to any number of such column dictionaries.
    make() runs once in each task, so that tables are built there and not in the driver."""
    kind = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(kind)
        step = make()
        for batch in batches:
            for part in rows_of(batch):
                for out in step({n: part.column(i).to_pylist() for i, n in enumerate(names)}):
                    yield pa.RecordBatch.from_pydict(out, schema=arrow)
        del step
        given_back()

    return df.mapInArrow(run, kind)


def rows_of(batch: pa.RecordBatch, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about `most` bytes, so that Python never holds many long texts at once."""
    n = batch.num_rows
    step = max(1, min(n, int(n * most / max(batch.nbytes, 1)))) if n else 1
    for at in range(0, n, step):
        yield batch.slice(at, step)


def fold(id_col: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % parts


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """Only the id, as long, and the text: whatever else the input holds can't clash with an operator's columns. With carry,
    all other columns travel in one struct, `carried`."""
    rest = [docs[c] for c in docs.columns if c not in (id_col, text_col)]
    own = [docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")]
    return docs.select(*own, *([F.struct(*rest).alias("carried")] if carry and rest else []))


def uncarried(out: DataFrame, like: DataFrame) -> DataFrame:
    """out's columns with those that texts() carried, as like has them: names, order and types of like."""
    return out.select(*(F.col(c if c in ("doc_id", "text") else f"carried.{c}").cast(like.schema[c].dataType).alias(c) for c in like.columns))
