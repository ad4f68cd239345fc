"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

``weight ~ share ** exponent`` over the sources' token shares. The exponent lies between 0 (all
sources alike) and 1 (as they are): the largest that reaches the target entropy, raised further
where a source would be repeated more often than allowed. Without a target it is the least
that the limit allows. It is found by bisection, six halvings
in one pass over the shares.

Each source gets ``weight * budget`` tokens, rounded to whole ones that add up to the budget: whole permutations of its documents, and of one more
permutation the first documents until the tokens are used up. A permutation is the order of a
keyed hash. Documents are laid into blocks that each hold every source in its weight.

Only DataFrame functions are used. A source may hold a third of all rows: places in a permutation
are counted by hash prefix first, with about as many prefixes as rows behind each, so that neither
window holds more than about the square root of a source's rows.

A document counts one token for every word and at least one, so that empty and null texts stay.
A null source is a source of its own. Repeated rows and ids are mixed as rows of their own; equal
ones are in or out together up to the order of equal rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import WORD, documents, free_name, stage

HALVINGS = 6
PASSES = 7


@dataclass(frozen=True)
class Mix:
    """``budget`` is a multiple of the input's tokens; None takes the least that loses no document."""

    target_entropy: float | None = 0.9  # as a part of the highest possible one
    max_repeats: float | None = 2.0
    budget: float | None = None
    block_tokens: int = 100_000
    seed: str = "mix"


def tokens(text: Column) -> Column:
    """Words of a text, one at least."""
    return F.greatest(F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)), F.lit(1)).cast("long")


def source_key(source: Column) -> Column:
    """Keeps a null source apart from every named one."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def _at(shares: DataFrame, exponents: list[float]) -> list:
    """(exponent, entropy, highest repetition at a budget of the input's size and at the covering one)."""
    powers = shares.select("p", "rel", F.explode(F.array(*[F.lit(x) for x in exponents])).alias("a"))
    q = F.pow("p", "a")
    rows = powers.groupBy("a").agg(
        F.sum(q).alias("z"),
        F.sum(q * F.log("p")).alias("l"),
        F.max(F.pow("p", F.col("a") - 1)).alias("r"),
        F.max(F.pow("rel", F.col("a") - 1)).alias("c"),
    )
    return rows.select("a", (F.log("z") - F.col("a") * F.col("l") / F.col("z")).alias("h"), (F.col("r") / F.col("z")).alias("r"), "c").collect()


def exponent(shares: DataFrame, mix: Mix) -> float:
    """The exponent for shares with columns p (of all tokens) and rel (of the largest source)."""
    n = shares.count()
    goal = None if mix.target_entropy is None or n < 2 else mix.target_entropy * math.log(n)

    def diverse(row) -> bool:
        return goal is None or row["h"] >= goal

    def sparing(row) -> bool:
        if mix.max_repeats is None:
            return True
        return (row["c"] if mix.budget is None else row["r"] * mix.budget) <= mix.max_repeats

    # [low, high) holds the last diverse exponent, (low, high] the first sparing one.
    brackets = {"diverse": (0.0, 1.0), "sparing": (0.0, 1.0)}
    ends = {row["a"]: row for row in _at(shares, [0.0, 1.0])}
    if diverse(ends[1.0]):
        brackets["diverse"] = (1.0, 1.0)
    if sparing(ends[0.0]):
        brackets["sparing"] = (0.0, 0.0)
    for _ in range(PASSES):
        parts = 1 << HALVINGS
        grid = {k: [lo + (hi - lo) * i / parts for i in range(parts + 1)] for k, (lo, hi) in brackets.items() if hi > lo}
        inner = sorted({x for g in grid.values() for x in g[1:-1]})
        if not inner:
            break
        rows = {row["a"]: row for row in _at(shares, inner)}
        for kind, g in grid.items():
            if kind == "diverse":
                i = max([j for j in range(1, parts) if diverse(rows[g[j]])], default=0)
            else:
                i = min([j for j in range(1, parts) if sparing(rows[g[j]])], default=parts) - 1
            brackets[kind] = (g[i], g[i + 1])
    if goal is None:  # nothing asks for a mix closer to the sources than the limit needs
        return 1.0 if mix.max_repeats is None else brackets["sparing"][1]
    return max(brackets["diverse"][0], brackets["sparing"][1])


def plan(counted: DataFrame, mix: Mix) -> DataFrame:
    """One row per source: sid, t (tokens), weight, share of the budget, whole copies and the rest.

    ``counted`` has sid and n_tokens. The plan is staged; its rows are the sources.
    """
    sums = stage(counted.groupBy("sid").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n")), "mix-sources")
    total = sums.agg(F.sum("t").alias("t"), F.max("t").alias("m")).first()
    if total["t"] is None:
        zero = F.lit(0).cast("long")
        return sums.select("sid", "t", "n", F.lit(0.0).alias("weight"), *[zero.alias(c) for c in ("quota", "copies", "rest")])
    shares = sums.select("sid", "t", "n", (F.col("t") / F.lit(total["t"])).alias("p"), (F.col("t") / F.lit(total["m"])).alias("rel"))
    a = exponent(shares, mix)
    norm = shares.agg(F.sum(F.pow("p", F.lit(a))).alias("z"), F.max(F.pow("p", F.lit(1 - a))).alias("need")).first()
    covering = mix.budget is None
    budget = round(total["t"] * (norm["z"] * norm["need"] if covering else mix.budget))
    weighted = shares.select("sid", "t", "n", (F.pow("p", F.lit(a)) / F.lit(norm["z"])).alias("weight"))
    quotas = whole_quotas(weighted, budget)
    if covering:  # no document is lost to rounding
        quotas = quotas.withColumn("quota", F.greatest("quota", "t"))
    copies = F.expr("quota div t")
    return stage(quotas.withColumn("copies", copies).withColumn("rest", F.col("quota") - F.col("copies") * F.col("t")), "mix-plan")


def whole_quotas(weighted: DataFrame, budget: int) -> DataFrame:
    """Adds ``quota``: whole tokens that add up to ``budget``, by largest remainder (ties: the smaller sid).

    Sources are ranked by remainder in two steps, first by thousandths, so that no window holds them all.
    """
    exact = F.col("weight") * F.lit(float(budget))
    parts = weighted.withColumn("_floor", F.floor(exact)).withColumn("_rest", exact - F.col("_floor"))
    parts = stage(parts.withColumn("_part", F.least(F.floor(F.col("_rest") * 1000), F.lit(999)).cast("int")), "mix-quotas")
    left = F.lit(budget) - parts.agg(F.sum("_floor").alias("s")).scalar()
    sums = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    above = Window.orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)  # at most 1,000 rows
    offsets = sums.select("_part", F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(F.desc("_rest"), "sid"))
    ranked = parts.withColumn("_rank", rank).join(F.broadcast(offsets), "_part")
    more = (F.col("_offset") + F.col("_rank") <= left).cast("long")
    return ranked.select("sid", "t", "n", "weight", (F.col("_floor") + more).alias("quota"))


def permutation_key(seed: str, copy: Column, doc_id: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), copy.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def placed(counted: DataFrame, planned: DataFrame, mix: Mix, only_last: bool = False) -> DataFrame:
    """Every use of a document (doc_id, sid, copy, n_tokens) with its key and its first token's place.

    ``start`` counts from the beginning of the source's stream. ``only_last`` leaves out the whole
    copies, of which every document is a part anyway.
    """
    digits = F.greatest(F.ceil(F.log(F.sqrt(F.col("n").cast("double"))) / F.log(F.lit(16.0))), F.lit(1)).cast("int")
    uses = counted.join(planned.select("sid", "t", "copies", "rest", "weight", digits.alias("digits")), "sid")
    first = F.col("copies") if only_last else F.lit(0).cast("long")
    uses = uses.withColumn("copy", F.explode(F.sequence(first, F.col("copies")))).where("copy < copies or rest > 0")
    key = permutation_key(mix.seed, F.col("copy"), F.col("doc_id"))
    uses = uses.withColumn("key", key).withColumn("bucket", F.expr("substring(key, 1, digits)"))
    sums = uses.groupBy("sid", "copy", "bucket").agg(F.sum("n_tokens").alias("in_bucket"))
    before = Window.partitionBy("sid", "copy").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("offset", F.coalesce(F.sum("in_bucket").over(before), F.lit(0))).drop("in_bucket")
    inside = Window.partitionBy("sid", "copy", "bucket").orderBy("key", "doc_id", "n_tokens")
    own = F.coalesce(F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    uses = uses.join(sums, ["sid", "copy", "bucket"]).withColumn("in_copy", F.col("offset") + own)
    return uses.where("copy < copies or in_copy < rest").withColumn("start", F.col("copy") * F.col("t") + F.col("in_copy"))


def counted_sources(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", source_key(F.col("source")).alias("sid"), tokens(F.col("text")).alias("n_tokens"))


def mix_table(docs: DataFrame, mix: Mix) -> DataFrame:
    """The mixture: doc_id, source, copy, n_tokens, start, block and order_key, a row for each use.

    Reading the rows by block and then by order_key gives the training order.
    """
    counted = stage(counted_sources(docs), "mix-tokens")
    uses = placed(counted, plan(counted, mix), mix)
    block = F.floor(F.col("start") / (F.col("weight") * F.lit(mix.block_tokens)))
    named = F.when(F.col("sid") != "n", F.expr("substring(sid, 2)"))
    order = F.md5(F.concat_ws("|", F.lit(mix.seed), F.lit("order"), F.col("key")))
    return uses.select("doc_id", named.alias("source"), "copy", "n_tokens", "start", block.alias("block"), F.substring(order, 1, 16).alias("order_key"))


def mix_documents(docs: DataFrame, mix: Mix) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture uses it; columns unchanged.

    A row's uses follow from its source's plan and the last key of the unfinished permutation, so
    the texts are neither shuffled nor sorted.
    """
    counted = stage(counted_sources(docs), "mix-tokens")
    planned = plan(counted, mix)
    last = placed(counted, planned, mix, only_last=True).groupBy("sid").agg(F.max("key").alias("last_key"))
    own, sid, copies, key, use = (free_name(docs, x) for x in ("_own", "_sid", "_copies", "_last_key", "_use"))
    limits = stage(
        planned.join(last, "sid", "left").select(F.col("sid").alias(sid), F.col("copies").alias(copies), F.col("last_key").alias(key)), "mix-limits"
    )
    rows = docs.withColumn(own, source_key(F.col("source")))
    in_last = (permutation_key(mix.seed, F.col(copies), F.col("doc_id")) <= F.col(key)).cast("long")
    times = F.col(copies) + F.coalesce(in_last, F.lit(0))
    joined = rows.join(limits, F.col(own) == F.col(sid)).withColumn(use, F.explode(F.sequence(F.lit(0).cast("long"), times)))
    return joined.where(F.col(use) > 0).select(docs.columns)


# Nearly even sources, and a quarter more tokens than there are, so that weights, whole copies and rests all count.
PRODUCTION = Mix(target_entropy=0.9999, max_repeats=2.0, budget=1.25)


def op1_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_table(documents(spark, sf_dir), PRODUCTION)


def op1_sql(mix: Mix) -> str:
    return _SQL.replace("{entropy}", repr(mix.target_entropy)).replace("{repeats}", repr(mix.max_repeats)).replace("{budget}", repr(mix.budget))


_SQL = r"""
WITH RECURSIVE counted AS (
  SELECT doc_id, coalesce('s' || source, 'n') AS sid,
         greatest(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')), 1)::BIGINT AS n_tokens
  FROM documents
), shares AS (
  SELECT sid, sum(n_tokens)::BIGINT AS t, sum(n_tokens) / (SELECT sum(n_tokens) FROM counted)::DOUBLE AS p
  FROM counted GROUP BY sid
), ends AS (
  SELECT (SELECT ln(sum(p)) - sum(p * ln(p)) / sum(p) FROM shares) >= {entropy} * (SELECT ln(count(*)) FROM shares)
         OR (SELECT count(*) FROM shares) < 2 AS diverse1,
         (SELECT max(1 / p) / count(*) * {budget} FROM shares) <= {repeats} AS sparing0
), bisect AS (
  SELECT 0 AS step, CASE WHEN diverse1 THEN 1.0 ELSE 0.0 END::DOUBLE AS dlo, 1.0::DOUBLE AS dhi,
         0.0::DOUBLE AS rlo, CASE WHEN sparing0 THEN 0.0 ELSE 1.0 END::DOUBLE AS rhi
  FROM ends
  UNION ALL
  SELECT step + 1,
         CASE WHEN h >= goal THEN (dlo + dhi) / 2 ELSE dlo END, CASE WHEN h >= goal THEN dhi ELSE (dlo + dhi) / 2 END,
         CASE WHEN r <= {repeats} THEN rlo ELSE (rlo + rhi) / 2 END, CASE WHEN r <= {repeats} THEN (rlo + rhi) / 2 ELSE rhi END
  FROM (
    SELECT step, any_value(dlo) AS dlo, any_value(dhi) AS dhi, any_value(rlo) AS rlo, any_value(rhi) AS rhi,
           {entropy} * ln(count(*)) AS goal,
           ln(sum(p ** ((dlo + dhi) / 2)))
             - any_value((dlo + dhi) / 2) * sum(p ** ((dlo + dhi) / 2) * ln(p)) / sum(p ** ((dlo + dhi) / 2)) AS h,
           max(p ** ((rlo + rhi) / 2 - 1)) / sum(p ** ((rlo + rhi) / 2)) * {budget} AS r
    FROM bisect, shares WHERE step < 42 GROUP BY step
  )
), chosen AS (
  SELECT greatest(dlo, rhi) AS a FROM bisect WHERE step = 42
), weighted AS (
  SELECT sid, t, p ** (SELECT a FROM chosen) / (SELECT sum(p ** (SELECT a FROM chosen)) FROM shares) AS weight
  FROM shares
), exact AS (
  SELECT sid, t, weight, (SELECT round(sum(t) * {budget}) FROM shares) AS budget,
         weight * (SELECT round(sum(t) * {budget}) FROM shares) AS x
  FROM weighted
), quotas AS (
  SELECT sid, t, weight, floor(x)::BIGINT
         + CASE WHEN row_number() OVER (ORDER BY x - floor(x) DESC, sid) <= budget - sum(floor(x)) OVER () THEN 1 ELSE 0 END AS quota
  FROM exact
), planned AS (
  SELECT sid, t, weight, quota // t AS copies, quota % t AS rest FROM quotas
), uses AS (
  SELECT doc_id, n_tokens, c.sid, t, weight, copies, rest,
         unnest(range(0, copies + 1)) AS copy
  FROM counted c JOIN planned p ON c.sid = p.sid
), keyed AS (
  SELECT *, md5('mix|' || copy || '|' || coalesce(doc_id::VARCHAR, 'null')) AS key FROM uses
), placed AS (
  SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY sid, copy ORDER BY key, doc_id, n_tokens
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS in_copy
  FROM keyed
)
SELECT doc_id, CASE WHEN sid <> 'n' THEN substring(sid, 2) END AS source, copy, n_tokens,
       (copy * t + in_copy)::BIGINT AS start,
       floor((copy * t + in_copy) / (weight * 100000))::BIGINT AS block,
       substring(md5('mix|order|' || key), 1, 16) AS order_key
FROM placed WHERE copy < copies OR in_copy < rest
"""

OP1_SQL = op1_sql(PRODUCTION)
