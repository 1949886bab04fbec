"""Helpers shared by the operators: stored intermediate tables, row-wise Arrow functions, text as bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide.session import scratch_dir

ROW = "row"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table, written below ``spark.checkpoint.dir`` and read back: a cut of the lineage that survives executors."""
    path = scratch_dir(df.sparkSession, f"{name}-")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_of_id(doc_id: str = "doc_id") -> Column:
    """CRC-32 of the id's decimal text, unsigned; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def hash_bound(wanted: int, count: int) -> int:
    """Of ``count`` 63-bit hashes about ``wanted`` are below this; never 0 for tables of any size that can be."""
    return (1 << 63) - 1 if count <= wanted else (wanted << 63) // count


def sampled(wanted: int, count: int, key: str = "doc_id") -> Column:
    """True for about ``wanted`` of ``count`` rows, chosen by the hash of the key; for all of them if they are no more."""
    if count <= wanted:
        return F.lit(True)
    return F.shiftrightunsigned(F.xxhash64(key), 1) < F.lit(hash_bound(wanted, count))


def pieces(batch: pa.RecordBatch, at_a_time: int) -> Iterator[tuple[pa.Array, pa.RecordBatch]]:
    """The batch of packed rows in slices of about ``at_a_time`` bytes of text: the packed column, and its fields."""
    row = batch.column(0)
    columns = pa.RecordBatch.from_arrays(row.flatten(), names=[f.name for f in row.type])
    sizes = pc.fill_null(pc.binary_length(columns.column("text")), 0).to_numpy(zero_copy_only=False) if "text" in columns.schema.names else np.full(batch.num_rows, 4096)
    slices = np.cumsum(sizes + 64) // at_a_time
    edges = [0, *(np.flatnonzero(np.diff(slices)) + 1).tolist(), batch.num_rows]
    for start, end in zip(edges, edges[1:]):
        yield row.slice(start, end - start), columns.slice(start, end - start)


def annotate(
    df: DataFrame, values: Callable[[pa.RecordBatch], list[pa.Array]], fields: str, at_a_time: int = 1 << 21
) -> DataFrame:
    """Columns ``row`` (all of df's columns, so that no name can clash) and ``fields``, computed from Arrow batches.

    ``values`` gets slices of df's rows, about ``at_a_time`` bytes of text each, and returns one array for each field.
    """
    new = T.StructType.fromDDL(fields)
    packed = df.select(F.struct(*[df[c] for c in df.columns]).alias(ROW))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for row, part in pieces(batch, at_a_time):
                    yield pa.RecordBatch.from_arrays([row, *values(part)], names=[ROW, *new.fieldNames()])

    return packed.mapInArrow(run, T.StructType([T.StructField(ROW, packed.schema[0].dataType), *new.fields]))


def unpacked(docs: DataFrame, annotated: DataFrame) -> DataFrame:
    """The columns of ``docs`` out of ``row``."""
    return annotated.select(*[F.col(ROW)[c].alias(c) for c in docs.columns])


# Bytes other than 0-9, a-z and those of non-ASCII letters become blanks, A-Z become a-z.
BARE = bytes(ord(" ") if b < 0x30 or 0x3A <= b < 0x41 or 0x5B <= b <= 0x60 or 0x7B <= b < 0x80 else b for b in range(256)).lower()


def bare_words(text: bytes) -> list[bytes]:
    """Words without ASCII punctuation, with A-Z (and no other letter) in lower case."""
    return text.translate(BARE).split()


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def words(text: bytes) -> list[bytes]:
    """Words between ASCII white space, with A-Z (and no other letter) in lower case."""
    return text.lower().split()

