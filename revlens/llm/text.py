"""Words of a text, as columns and in Python, by the two definitions the queries use."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from revlens.sources.tables import keep

#: Runs of anything but space, tab, line feed, vertical tab, form feed, carriage return.
SPACED = r"[^\x20\x09-\x0D]+"
#: The same in UTF-8 bytes: every byte of a longer character is above 0x7F.
SPACED_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")
#: Runs of digits, letters and non-ASCII characters, of text whose A-Z are lower-cased.
ALNUM_BYTES = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SPACED)).cast("long")


def spaced_words(text: str | bytes | None) -> list[bytes]:
    """Words between white space; A-Z lower-cased (bytes.lower leaves other characters)."""
    return SPACED_BYTES.findall(_bytes(text).lower())


def alnum_words(text: str | bytes | None) -> list[bytes]:
    return ALNUM_BYTES.findall(_bytes(text).lower())


def _bytes(text: str | bytes | None) -> bytes:
    return text.encode("utf-8", "replace") if isinstance(text, str) else text or b""


#: Texts of an Arrow batch that are Python objects at the same time.
_SLICE = 256


def slices(batch):
    """A batch or an array in small parts that share its memory."""
    for at in range(0, len(batch), _SLICE):
        yield batch.slice(at, _SLICE)


def piecewise(function: Callable[[pa.Array], pa.Array]) -> Callable:
    """The function for an Arrow UDF that hands on the results of a few rows at a time, so a
    worker never holds those of a whole batch."""

    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield from map(function, slices(batch))

    return pieces


#: Of texts on their way to a Python worker. Executors hold a batch in several buffers, each
#: of which grows by doubling, outside their heaps; Spark's own value is 64 MiB.
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"

#: Whether Spark joins the operators of a stage into one Java method. Those of long joins and sums
#: are so large that compiling them takes hundreds of MB outside the heap, which stay taken.
_JOINED_CODE = "spark.sql.codegen.wholeStage", "false"


@contextmanager
def _unless_set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    if name in spark.conf.getAll:
        yield
        return
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name)


def small_batches(spark: SparkSession):
    """Plans that are made and run in here hand texts to Python in batches of 4 MiB, unless the
    session says otherwise; afterwards its settings are as before."""
    return _unless_set(spark, *_BATCH_BYTES)


def separate_operators(spark: SparkSession):
    """Plans that are made and run in here keep their operators' code apart, unless the session
    says otherwise; afterwards its settings are as before."""
    return _unless_set(spark, *_JOINED_CODE)


def utf8(texts: pa.Array) -> Iterator[bytes | None]:
    """The texts as UTF-8, a few at a time."""
    for at in range(0, len(texts), _SLICE):
        yield from texts.slice(at, _SLICE).cast(pa.binary()).to_pylist()


def long_lists(lists: list[np.ndarray]) -> pa.Array:
    """Arrays of 64-bit values as one column of lists."""
    ends = np.cumsum([0, *map(len, lists)])
    values = np.concatenate([np.empty(0, np.uint64), *lists]).astype(np.uint64).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def held_out(id_column: str, modulus: int, remainder: int) -> Column:
    """Rows that no label is learned from; a null id counts as the text ``null``."""
    key = F.coalesce(F.col(id_column).cast("string"), F.lit("null"))
    return F.crc32(key.cast("binary")) % modulus == remainder


#: Ranges of hashes that ``lowest`` counts, a bound on what the driver gets.
_RANGE_BITS = 16


def lowest(rows: DataFrame, hashed: str, most: int) -> DataFrame:
    """The ``most`` distinct rows with the lowest values of a 64-bit hash column, all if fewer.

    Equal rows count once, so one that occurs very often cannot fill the sample. Counts
    by range of hashes say which ranges can hold the lowest; only their rows reach the
    task that sorts, however many partitions there are.
    """
    distinct = keep(rows.distinct())
    ranges = F.shiftright(hashed, 64 - _RANGE_BITS)
    counts = distinct.groupBy(ranges.alias("_range")).count().collect()
    last, total = None, 0
    for last, n in sorted(map(tuple, counts)):
        total += n
        if total >= most:
            break
    first = distinct if last is None else distinct.where(ranges <= last)
    return first.orderBy(hashed, *[c for c in rows.columns if c != hashed]).limit(most)
