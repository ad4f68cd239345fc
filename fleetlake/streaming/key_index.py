"""Which stored files may hold a key: a Bloom filter for each file and hour, kept beside the files.

A micro-batch of readings must know whether a key (server, instant) was stored before. With the filters of the days
it touches it opens only files that may hold one of its keys, as a rule none, instead of all readings of
those days. A filter has about ``BITS_PER_KEY`` bits for each key of its hour, so it grows with its file only.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.operators.series import MICROS, slice_of
from fleetlake.session import listing_settings
from fleetlake.sources.filelist import Folder

BITS_PER_KEY = 16
PROBES = 4  # a key that is not there hits by chance less than once in 400 times
SALTS = 8
SLICE_KEYS = 1 << 20  # keys whose bits are set at a time; their bits take up to 32 MB before they are packed
NO_HOUR = -1
INDEX = "part string, file string, hour long, words long, bits array<long>"


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys])


def hour_of(ts: str) -> Column:
    return F.coalesce(slice_of(F.col(ts), MICROS["hour"]), F.lit(NO_HOUR).cast("long"))


def _place(hash_: Column, words: Column, probe: int) -> Column:
    """Bit number of one probe: steps of the upper half of the hash from the lower half; sizes are powers of two."""
    low, high = hash_.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(hash_, 32).bitwiseOR(F.lit(1))
    return (low + high * F.lit(probe)).bitwiseAND(words * F.lit(64) - F.lit(1))


def may_hold(hash_: Column, words: Column, bits: Column) -> Column:
    hit = F.lit(True)
    for probe in range(PROBES):
        place = _place(hash_, words, probe)
        word = F.element_at(bits, (F.shiftright(place, 6) + 1).cast("int"))
        hit = hit & (F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return hit


@F.arrow_udf(T.ArrayType(T.LongType()))
def _filter_bits(hashes: pa.Array, words: pa.Array) -> pa.Array:
    """The words of each filter from the hashes of its keys: every probe sets the bit that ``may_hold`` looks at."""
    offsets, sizes = np.asarray(hashes.offsets, np.int64), np.asarray(words, np.int64)
    given = np.asarray(hashes.values).view(np.uint64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    done, first = [], 0
    while first < len(sizes):
        # So many filters at a time as have about SLICE_KEYS keys together.
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_KEYS, "right")) - 1)
        h, n = given[offsets[first] : offsets[last]], np.diff(offsets[first : last + 1])
        mask = np.repeat((sizes[first:last] * 64 - 1).astype(np.uint64), n)
        at = np.repeat(((starts[first:last] - starts[first]) * 64).astype(np.uint64), n)
        low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
        bits = np.zeros((starts[last] - starts[first]) * 64, np.bool_)
        for probe in range(PROBES):
            bits[at + ((low + high * np.uint64(probe)) & mask)] = True
        done.append(np.packbits(bits, bitorder="little").view(np.int64))
        first = last
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(np.concatenate(done or [np.zeros(0, np.int64)])))


def filters(rows: DataFrame, by: list[str]) -> DataFrame:
    """``(*by, words, bits)``: the filter of the hashes ``h`` of each group, as an array of words.

    One shuffle by group. A group's hashes are a list for that time, no more than a file has rows; the bits are
    set in arrays, so a key costs no row of its own.
    """
    needed = F.ceil(F.log2(F.count(F.lit(1)) * F.lit(BITS_PER_KEY / 64.0)))
    size = F.pow(F.lit(2.0), F.greatest(needed, F.lit(0))).cast("long").alias("words")
    groups = rows.groupBy(*by).agg(size, F.collect_list("h").alias("hs"))
    return groups.select(*by, "words", _filter_bits("hs", "words").alias("bits"))


def index_path(folder: Folder) -> str:
    """Where the filters of a folder are: ``data/<write>/<name>=<value>`` has them in ``index/<write>/at=<value>``."""
    _, write, last = folder.path.split("/")
    return f"index/{write}/at={last.split('=', 1)[1]}"


def write_index(spark: SparkSession, root: str, folders: list[Folder], schema: str, keys: list[str], ts: str) -> None:
    """Filters of all files of folders of one write."""
    if not folders:
        return
    types = T.StructType.fromJson(json.loads(schema))
    with listing_settings(spark):
        rows = spark.read.schema(types).parquet(*[f"{root}/{f.path}" for f in folders])
    file = F.col("_metadata.file_path")
    hashed = rows.select(file.alias("file"), hour_of(ts).alias("hour"), key_hash(keys).alias("h"))
    at = F.url_decode(F.regexp_extract("file", r"=([^/=]+)/[^/]*$", 1))
    # Parts of folders of one write are few: one per day that a batch touches, or per bin that was compacted.
    parts = spark.createDataFrame([(f.path.rsplit("=", 1)[1], f.part) for f in folders], "at string, part string")
    built = filters(hashed, ["file", "hour"]).withColumn("at", at).join(parts, "at")
    write = folders[0].path.split("/")[1]
    built.select("part", "file", "hour", "words", "bits", "at").repartition("at").write.partitionBy("at").parquet(
        f"{root}/index/{write}"
    )


def files_that_may_hold(spark: SparkSession, root: str, folders: list[Folder], fresh: DataFrame, keys: list[str], ts: str) -> list[str]:
    """Files of ``folders`` that may hold a key of ``fresh``, which has its part in ``_day``.

    Keys meet the filters of their hour only; a crowded hour is dealt to several copies of its filters.
    """
    if not folders:
        return []
    with listing_settings(spark):
        stored = spark.read.schema(INDEX).parquet(*[f"{root}/{index_path(f)}" for f in folders])
    salted = stored.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    asked = fresh.select(F.col("_day").alias("part"), hour_of(ts).alias("hour"), key_hash(keys).alias("h"))
    asked = asked.withColumn("salt", F.pmod("h", F.lit(SALTS)).cast("int")).withColumnsRenamed({c: f"_{c}" for c in ("part", "hour", "salt")})
    same = F.lit(True)
    for c in ("part", "hour", "salt"):
        same = same & (F.col(c) == F.col(f"_{c}"))
    hit = same & may_hold(F.col("h"), F.col("words"), F.col("bits"))
    # Names of files, of those days that the batch touches.
    return sorted(r["file"] for r in salted.join(asked, hit, "left_semi").select("file").distinct().collect())
