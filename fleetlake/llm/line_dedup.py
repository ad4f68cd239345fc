"""Line dedup with levelled sorted runs of line hashes.

A line's key is the line stripped of ``[ \\t-\\r]`` at both ends with A-Z lower-cased; keys of at
least 20 code points count. Keys that occur in at least ``min_docs`` documents lose all their
lines, except in the largest ``doc_id`` that holds them.

Runs are tables of (128-bit key hash, number of documents up to ``min_docs``, largest document),
sorted by hash. Every batch of documents is merge-anti-joined with the runs, which leaves out the
keys that are settled already (enough documents, none later), and what is left is added as a run
of level 0. ``fan_out`` runs of a level are compacted into one run of the next. A key in a third
of all documents therefore costs one row per run. The runs of a corpus are the parts of a path table with a
numbered list, one part per level, so they can be opened again by its path: a batch or a compaction is there
as a whole or not at all.

Only documents that may lose a line meet their lost keys by a shuffle; the others, told by a filter of fixed
size over their ids, are handled where they are read.

A document is a ``doc_id``: repeated rows of an id count once, and all rows of an id must come in
one batch. Rows with a null id keep every line and count for no key. A null or empty text has one
empty line.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.llm.common import BLANKS, arrow_rows, bit_filter, documents, free_name, remove, scratch_path, stage
from fleetlake.sources import filelist

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FAN_OUT = 3


def line_key(line: str) -> bytes | None:
    """Hash of a line's key, or None for keys that are too short to count."""
    key = line.strip(BLANKS)
    if len(key) < MIN_CHARS:
        return None
    return xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower())


def _keys(cols: dict[str, list]) -> pa.RecordBatch:
    found, ids = [], []
    for doc, text in zip(cols["doc_id"], cols["text"]):
        own = {k for line in (text or "").split("\n") if (k := line_key(line))}
        found.extend(own)
        ids.extend([doc] * len(own))
    halves = np.frombuffer(b"".join(found), dtype="<i8").reshape(-1, 2)
    return pa.RecordBatch.from_arrays(
        [pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(ids, pa.int64())], names=["k1", "k2", "doc"]
    )


def line_keys(docs: DataFrame) -> DataFrame:
    """(k1, k2, doc), one row for each key of each document row."""
    kept = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return arrow_rows(kept, ["doc_id", "text"], _keys, "k1 long, k2 long, doc long")


RUN = "k1 long, k2 long, n long, top long"


class LineRuns:
    """The levelled runs of one corpus: a path table at ``root`` that any session can open and continue."""

    def __init__(self, spark: SparkSession, root: str | None = None, min_docs: int = MIN_DOCS, fan_out: int = FAN_OUT):
        self.spark, self.min_docs, self.fan_out = spark, min_docs, fan_out
        self.root = root or scratch_path(spark, "line-runs")

    @property
    def levels(self) -> list[list[str]]:
        """The runs' folders by level."""
        folders = filelist.listing(self.spark, self.root).folders
        top = max((int(f.part) for f in folders), default=0)
        return [[f.path for f in folders if f.part == str(level)] for level in range(top + 1)]

    def _level(self, level: int) -> list[filelist.Folder]:
        return filelist.listing(self.spark, self.root).of({str(level)})

    def _read(self, folders: list[filelist.Folder]) -> DataFrame:
        return self.spark.read.schema(RUN).parquet(*[f"{self.root}/{f.path}" for f in folders])

    def _merged(self, folders: list[filelist.Folder]) -> DataFrame:
        return (
            self._read(folders)
            .groupBy("k1", "k2")
            .agg(F.least(F.sum("n"), F.lit(self.min_docs)).alias("n"), F.max("top").alias("top"))
        )

    def _write(self, run: DataFrame, level: int) -> list[filelist.Folder]:
        """A run is the folder of one write; its rows stay where the aggregation left them, sorted."""
        name = f"data/{uuid.uuid4().hex}"
        ordered = run.select("k1", "k2", "n", "top").sortWithinPartitions("k1", "k2")
        ordered.write.parquet(f"{self.root}/{name}/{filelist.PART}={level}")
        return filelist.folders_of(self.spark, self.root, name)

    def settled(self) -> DataFrame | None:
        """Keys with enough documents so far, and the largest of these documents."""
        folders = list(filelist.listing(self.spark, self.root).folders)
        if not folders:
            return None
        return self._merged(folders).where(F.col("n") >= self.min_docs).select("k1", "k2", "top")

    def add(self, keys: DataFrame, name: str | None = None) -> None:
        """Add a batch of ``line_keys`` rows; its documents must be new to the runs.

        A batch with a ``name`` is added once: after a failure it can be given again.
        """
        done = filelist.listing(self.spark, self.root).notes.get("batches", [])
        if name is None or name not in done:
            own = (
                keys.distinct()
                .groupBy("k1", "k2")
                .agg(F.least(F.count("*"), F.lit(self.min_docs)).alias("n"), F.max("doc").alias("top"))
            )
            settled = self.settled()
            if settled is not None:
                old = settled.select(F.col("k1").alias("o1"), F.col("k2").alias("o2"), F.col("top").alias("old_top"))
                known = (F.col("k1") == F.col("o1")) & (F.col("k2") == F.col("o2")) & (F.col("top") <= F.col("old_top"))
                own = own.join(old, known, "left_anti")
            notes = {"batches": [*done, name]} if name else None
            filelist.swap(self.spark, self.root, [], self._write(own, 0), _json(RUN), notes)
        level = 0
        while len(self._level(level)) >= self.fan_out:
            old = self._level(level)
            filelist.swap(self.spark, self.root, old, self._write(self._merged(old), level + 1), _json(RUN))
            for folder in old:
                remove(self.spark, f"{self.root}/{folder.path}")
            level += 1

    def close(self) -> None:
        """Delete the runs; without this they stay and can be continued."""
        remove(self.spark, self.root)


def _json(ddl: str) -> str:
    return T.StructType.fromDDL(ddl).json()


def _batched(docs: DataFrame, batches: int) -> tuple[DataFrame, int]:
    """Line keys with a batch number: ranges of ``doc_id``, the largest ids first."""
    shares = [i / batches for i in range(1, batches)]
    row = docs.agg(F.percentile_approx("doc_id", shares, 1000).alias("p")).first()
    bounds = sorted({b for b in (row["p"] or [])}, reverse=True)
    number = F.lit(len(bounds))
    for i, bound in reversed(list(enumerate(bounds))):
        number = F.when(F.col("doc") > bound, i).otherwise(number)
    return line_keys(docs).withColumn("batch", number), len(bounds) + 1


def dropped_keys(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(doc, keys): the keys a document loses, for documents that lose any.

    The runs are built batch by batch; the line keys are computed once and staged.
    """
    spark = docs.sparkSession
    keys, n = _batched(docs, batches)
    path = scratch_path(spark, "line-keys")
    keys.write.partitionBy("batch").parquet(path)
    staged = spark.read.schema("k1 long, k2 long, doc long, batch int").parquet(path)
    runs = LineRuns(spark)
    for i in range(n):
        runs.add(staged.where(F.col("batch") == i).drop("batch"), f"batch-{i}")
    settled = scratch_path(spark, "line-settled")
    runs.settled().write.parquet(settled)
    runs.close()
    lost = (
        staged.join(spark.read.schema("k1 long, k2 long, top long").parquet(settled), ["k1", "k2"])
        .where(F.col("doc") != F.col("top"))
        .select("doc", F.struct("k1", "k2").alias("key"))
    )
    # A list holds at most the lines of its own document.
    return lost.groupBy("doc").agg(F.collect_set("key").alias("keys"))


def kept_lines(text: str | None, lost: set[bytes]) -> tuple[str, int, int]:
    """The text without its lost lines, its number of lines, and how many were dropped."""
    lines = (text or "").split("\n")
    kept = [line for line in lines if line_key(line) not in lost] if lost else lines
    return "\n".join(kept), len(lines), len(lines) - len(kept)


def dedup_lines(docs: DataFrame, batches: int = BATCHES, text_out: bool = True) -> DataFrame:
    """``docs`` with the repeated lines removed from ``text``, and columns n_lines, n_dropped.

    All other columns stay as they are; ``n_chars``, if there, is counted anew. With
    ``text_out=False`` only doc_id, n_lines, n_dropped and kept_sha256 are returned.
    """
    lost = stage(dropped_keys(docs, batches), "lost-lines")
    doc, column = free_name(docs, "_lost_doc"), free_name(docs, "_lost_keys")
    source = docs if text_out else docs.select("doc_id", "text")
    may_lose = bit_filter(lost.select(F.xxhash64("doc").alias("h")), F.xxhash64("doc_id"))
    named = lost.select(F.col("doc").alias(doc), F.col("keys").alias(column))
    met = source.where(may_lose).join(named, F.col("doc_id") == F.col(doc), "left").drop(doc)
    joined = source.where(~may_lose).withColumn(column, F.lit(None).cast(lost.schema["keys"].dataType)).unionByName(met)
    kept = [f for f in source.schema.fields if f.name not in ("n_lines", "n_dropped")]
    if text_out:
        kept = [T.StructField("n_chars", T.LongType()) if f.name == "n_chars" else f for f in kept]
    else:
        kept = [f for f in kept if f.name == "doc_id"]
    extra = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    if not text_out:
        extra.append(T.StructField("kept_sha256", T.StringType()))
    schema = T.StructType(kept + extra)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            if not batch.num_rows:
                continue
            names = batch.schema.names
            out = []
            for text, keys in zip(batch.column(names.index("text")), batch.column(names.index(column))):
                found = {k["k1"].to_bytes(8, "little", signed=True) + k["k2"].to_bytes(8, "little", signed=True) for k in keys.as_py() or []}
                out.append(kept_lines(text.as_py(), found))
            arrays = []
            for f in schema.fields:
                if f.name == "n_lines":
                    arrays.append(pa.array([x[1] for x in out], pa.int64()))
                elif f.name == "n_dropped":
                    arrays.append(pa.array([x[2] for x in out], pa.int64()))
                elif f.name == "kept_sha256":
                    arrays.append(pa.array([hashlib.sha256(x[0].encode("utf-8", "surrogatepass")).hexdigest() for x in out]))
                elif f.name == "text":
                    arrays.append(pa.array([x[0] for x in out], pa.string()))
                elif f.name == "n_chars":
                    arrays.append(pa.array([len(x[0]) for x in out], pa.int64()))
                else:
                    arrays.append(batch.column(names.index(f.name)))
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema.fields])

    return joined.mapInArrow(run, schema)


def op3_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(documents(spark, sf_dir), text_out=False)


OP3_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), repeated AS (
  SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT keyed.*, top IS NOT NULL AND doc_id <> top AS lost FROM keyed LEFT JOIN repeated USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
