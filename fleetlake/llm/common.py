"""What the text operators share: table readers, staging, and helpers for Arrow tasks."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.session import scratch_path, stage  # noqa: F401

# White space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"

# Rows handed to one vectorised step, and the characters at which it starts earlier.
BATCH_ROWS = 4000
BATCH_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def arrow_rows(
    df: DataFrame,
    columns: list[str],
    step: Callable[[dict[str, list]], pa.RecordBatch],
    schema: str,
    text: str = "text",
    batch_chars: int = BATCH_CHARS,
    done: Callable[[], None] | None = None,
) -> DataFrame:
    """Apply ``step`` to bounded slices of the named columns, as lists of Python values.

    A slice ends at ``BATCH_ROWS`` rows or once its texts exceed ``batch_chars`` characters, so what
    ``step`` holds follows the longest single text; the batch that Spark hands over (64 MB, by
    ``spark.sql.execution.arrow.maxBytesPerBatch``, or one row) comes on top of it.
    ``done`` drops what the steps of a task remember, since Spark uses its Python processes again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                sizes = pc.fill_null(pc.utf8_length(batch.column(columns.index(text))), 0).to_pylist()
                start = total = 0
                for i in range(batch.num_rows):
                    if i > start and (i - start >= BATCH_ROWS or total + sizes[i] > batch_chars):
                        yield step(_lists(batch.slice(start, i - start), columns))
                        start, total = i, 0
                    total += sizes[i]
                if batch.num_rows > start:
                    yield step(_lists(batch.slice(start), columns))
        finally:
            if done:
                done()
            release()

    return df.select(*columns).mapInArrow(run, schema)


def release() -> None:
    """Hand what a task no longer needs back to the system: the Python process lives on and runs other tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library, where it is that
    if trim:
        trim(0)


def _lists(batch: pa.RecordBatch, columns: list[str]) -> dict[str, list]:
    return {c: batch.column(i).to_pylist() for i, c in enumerate(columns)}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser over unsigned integers (wrapping arithmetic)."""
    x = np.asarray(x, dtype=np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


FILTER_BITS = 1 << 23  # one mebibyte, whatever the size of the tables


def bit_filter(hashes: DataFrame, here: Column, bits: int = FILTER_BITS) -> Column:
    """Whether the hash ``here`` may be among ``hashes`` (one column ``h``): never false for one that is.

    The filter is an array of ``bits / 64`` words in a scalar subquery, built by one aggregation over word numbers.
    With more hashes than bits it lets most rows through, which costs work and changes no result.
    """
    bit = hashes.select(F.pmod("h", F.lit(bits)).alias("_bit"))
    words = bit.groupBy(F.shiftright("_bit", 6).cast("int").alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_bit & 63 as int))")).alias("_bits")
    )
    every = hashes.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("_word"))
    filled = every.join(words, "_word", "left").select("_word", F.coalesce("_bits", F.lit(0).cast("long")).alias("_bits"))
    in_order = F.array_sort(F.collect_list(F.struct("_word", "_bits")))
    table = filled.agg(F.transform(in_order, lambda w: w["_bits"]).alias("words")).scalar()
    place = F.pmod(here, F.lit(bits))
    word = F.element_at(table, (F.shiftright(place, 6) + 1).cast("int"))
    return F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use, so that helper columns never clash."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def remove(spark: SparkSession, path: str) -> None:
    """Delete a staged table that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
