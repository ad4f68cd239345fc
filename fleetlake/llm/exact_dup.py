"""Exact duplicates by progressive refinement: length, then a hash of the beginning, then of the whole text.

One scan reads length and beginning of every text into a narrow table. Lengths that occur once are
settled; among the others, so are beginnings that occur once with their length. What is left goes into
a filter of fixed size, and only rows that hit it have their whole text hashed. A false hit costs one
hash and changes nothing, since the last step compares length and SHA-256 of the whole text.

A group of copies may hold a large part of all rows: groups are combined before the shuffle, and the rows
of the largest groups (at most ``HOT_GROUPS`` of them) meet their group by broadcast, the others by a shuffle.

Defined results: a null text is the empty text; equal is equal byte for byte. Of equal texts the row with
the largest id stays, null ids count as smaller than any other; exactly one of repeated rows with that id
stays. Rows of a group without any id have a null ``keep_id``. Empty tables give empty results, and further
columns of the input are neither read nor disturbed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import FILTER_BITS, bit_filter, documents, stage

PREFIX_CHARS = 256  # beginning of a text that the second step compares
HOT_GROUPS = 1000  # at most so many groups can hold a thousandth of the rows each


def _whole(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def _size_and_start(text: str) -> list[Column]:
    whole = _whole(text)
    return [F.octet_length(whole).alias("_size"), F.xxhash64(F.substring(whole, 1, PREFIX_CHARS)).alias("_start")]


def suspects(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(_size, _start)`` of every length and beginning that more than one row has."""
    narrow = stage(docs.select(*_size_and_start(text)), "sizes")
    sizes = narrow.groupBy("_size").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_size")
    starts = narrow.groupBy("_size", "_start").agg(F.count(F.lit(1)).alias("_n"))
    # The second step looks at nothing whose length is unique; the join is on one row per length.
    return starts.join(sizes, "_size", "left_semi").filter("_n > 1").select("_size", "_start")


def _hashed(docs: DataFrame, text: str, columns: list[Column], every_hash: bool) -> DataFrame:
    """``columns``, whether the row is a suspect, and the hash of the whole text of suspects (or of every row)."""
    found = stage(suspects(docs, text), "suspects")
    sized = docs.select(*columns, _whole(text).alias("_text"), *_size_and_start(text))
    both = F.xxhash64("_size", "_start")
    flagged = sized.withColumn("_suspect", bit_filter(found.select(both.alias("h")), both, FILTER_BITS))
    whole = F.sha2("_text", 256)
    return flagged.withColumn("_sha", whole if every_hash else F.when(F.col("_suspect"), whole)).drop("_text", "_start")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every_hash: bool = False) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for every row.

    Without ``every_hash`` the hash is null for rows that an earlier step has already told apart.
    """
    columns = [F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("_row")]
    # Written, so that a row keeps its number between the two uses below.
    rows = stage(_hashed(docs, text, columns, every_hash), "hashed")
    alone = rows.filter("not _suspect")
    shared = rows.filter("_suspect")
    groups = stage(
        shared.groupBy("_size", "_sha").agg(
            F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "_row")).alias("_keep")
        ),
        "groups",
    )
    hot_size = shared.agg((F.count(F.lit(1)) / F.lit(HOT_GROUPS)).alias("n")).scalar()
    hot = groups.filter(F.col("group_size") > hot_size)
    of_hot = shared.join(F.broadcast(hot), ["_size", "_sha"])
    rest = shared.join(F.broadcast(hot.select("_size", "_sha")), ["_size", "_sha"], "left_anti")
    of_rest = rest.join(groups.filter(F.col("group_size") <= hot_size), ["_size", "_sha"])

    def told(part: DataFrame) -> DataFrame:
        kept = (F.col("_row") == F.col("_keep._row")).alias("kept")
        return part.select("doc_id", F.col("_keep.doc_id").alias("keep_id"), "group_size", kept, F.col("_sha").alias("text_sha256"))

    one = alone.select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )
    return one.unionByName(told(of_hot)).unionByName(told(of_rest))


def keep_exact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts, with all its columns; copies are combined before the shuffle."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = _hashed(docs, text, [row.alias("_doc"), F.col(doc_id).alias("_id")], False)
    alone = rows.filter("not _suspect").select("_doc")
    kept = rows.filter("_suspect").groupBy("_size", "_sha").agg(F.max_by("_doc", F.struct("_id")).alias("_doc"))
    return alone.unionByName(kept.select("_doc")).select("_doc.*")


def op11_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir), every_hash=True)


OP11_SQL = """
with t as (select doc_id, coalesce(text, '') as text from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       row_number() over (partition by text order by doc_id desc nulls last) = 1 as kept,
       sha256(text) as text_sha256
from t window w as (partition by text)
"""
