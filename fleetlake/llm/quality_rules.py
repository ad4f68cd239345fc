"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Base rule: fewer than 50 words, or more than half of them inside repeated three-word windows. The
method adds statistics of a text (``RULES``) and a cut-off for each, per stratum (language):

* cut-offs are tried jointly, one for each rule at a time: step ``s`` of ``SEVERITIES`` takes for each rule the least
  level that at most that share of *all* documents of the stratum reach, so no rating decides what is tried;
* the rated documents of a stratum are its holdout; a *good* one has quality 1 and no toxicity. Good documents
  that any of the rules rejects are counted, and the exact binomial (Clopper-Pearson) test asks whether the share of
  good documents rejected could still exceed ``MAX_FALSE``;
* the test level is ``LEVEL`` divided by the strata (Bonferroni). Steps are tested from the most lenient on and
  the first failure ends the sequence, which needs no further correction;
* the cut-offs of the most severe step that passed are used. A stratum needs ``log(LEVEL / strata) / log(1 -
  MAX_FALSE)`` good ratings before any step can pass (217 with four strata); with fewer it gets none.

So with probability ``1 - LEVEL`` no stratum loses more than ``MAX_FALSE`` of its good documents
by these cut-offs. A null language is a stratum of its own, null texts have no words, repeated rows
are judged row by row (ratings: once per doc_id, by the lowest), extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.llm.common import WORD, documents, labels, stage

MAX_FALSE = 0.02
LEVEL = 0.05
GRID = 40
SEVERITIES = (0.0005, 0.001, 0.002, 0.004, 0.008, 0.015, 0.03, 0.06, 0.12, 0.25, 0.5)
# Statistic in [0, 1], of which high values are bad.
RULES = ("symbol_share", "dup_line_share", "repeat_share", "upper_share")

# A place takes the low 24 bits of a sort key; longer texts and hash clashes take the exact path.
PLACE_BITS = 24
PLACES = 1 << PLACE_BITS


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), 1)


def _covered(places: Column) -> Column:
    """Number of words in the windows of three that begin at the sorted places."""
    n = F.size(places)
    following = F.transform(places, lambda p, i: F.least(F.coalesce(F.get(places, i + 1) - p, F.lit(3)), F.lit(3)))
    return F.when(n > 0, F.aggregate(following, F.lit(0).cast("long"), lambda a, x: a + x)).otherwise(F.lit(0)).cast("long")


def base_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Windows of three words are hashed; hash and place share a number, so that one sort of numbers
    brings equal windows together. Neighbours in that order are compared by their words.
    """
    text = F.coalesce(F.col("_text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(WORD)))
    rows = docs.select(*keep, F.col("text").alias("_text"))
    rows = rows.select(
        *keep,
        _words(text).alias("_w"),
        (F.char_length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"[A-Z]")).cast("long").alias("_upper"),
        lines.alias("_lines"),
    )
    w = F.col("_w")
    n = F.size("_w")
    mask = F.lit(-PLACES).cast("long")
    packed = F.transform(
        F.slice(w, 1, F.greatest(n - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(mask).bitwiseOR(i.cast("long")),
    )
    # A one-row generator keeps the optimiser from computing a column again inside a lambda.
    rows = _hold(rows, keep + ["word_chars", "n_symbols", "_upper", "_w", "_lines"], _k=F.sort_array(packed))
    k = F.col("_k")
    place = F.lit(PLACES - 1).cast("long")
    # Neighbours with equal hash bits: the later place of each such pair.
    pairs = F.filter(
        F.transform(
            k,
            lambda x, i: F.when(
                (i > 0) & (x.bitwiseAND(mask) == F.get(k, i - 1).bitwiseAND(mask)),
                F.struct(F.get(k, i - 1).bitwiseAND(place).cast("int").alias("a"), x.bitwiseAND(place).cast("int").alias("b")),
            ),
        ),
        lambda x: x.isNotNull(),
    )
    rows = _hold(rows, keep + ["word_chars", "n_symbols", "_upper", "_w", "_lines"], _p=pairs)
    p = F.col("_p")

    def same(x: Column) -> Column:
        both = [F.get(w, x["a"] + j) == F.get(w, x["b"] + j) for j in range(3)]
        return both[0] & both[1] & both[2]

    unsure = (n >= PLACES) | F.exists(p, lambda x: ~same(x))
    starts = F.sort_array(F.array_distinct(F.flatten(F.transform(p, lambda x: F.array(x["a"], x["b"])))))
    # The exact path sorts the windows themselves.
    windows = F.sort_array(
        F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(F.get(w, i).alias("x"), F.get(w, i + 1).alias("y"), F.get(w, i + 2).alias("z"), i.alias("at")))
    )
    rows = _hold(
        rows,
        keep + ["word_chars", "n_symbols", "_upper", "_w", "_lines"],
        _s=F.when(~unsure, starts),
        _e=F.when(unsure & (n >= 3), windows),
    )
    e = F.col("_e")

    def like(x: Column, y: Column) -> Column:
        return (x["x"] == y["x"]) & (x["y"] == y["y"]) & (x["z"] == y["z"])

    exact = F.transform(
        F.filter(e, lambda x, i: F.coalesce(like(x, F.get(e, i - 1)), F.lit(False)) | F.coalesce(like(x, F.get(e, i + 1)), F.lit(False))),
        lambda x: x["at"],
    )
    rows = _hold(
        rows,
        keep + ["word_chars", "n_symbols", "_upper", "_lines"],
        n_words=n.cast("long"),
        _starts=F.coalesce(F.col("_s"), F.sort_array(exact), F.array().cast("array<int>")),
    )
    return rows.select(
        *keep,
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _covered(F.col("_starts")).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.col("_upper").alias("n_upper"),
    )


def _hold(rows: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    made = F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    return rows.select(*keep, made)


def statistics(counts: DataFrame) -> DataFrame:
    """The rule statistics beside the counts."""
    chars, words, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("word_chars", "n_words", "n_lines"))
    return counts.withColumns(
        {
            "symbol_share": F.col("n_symbols") / chars,
            "dup_line_share": F.col("n_dup_lines") / lines,
            "repeat_share": F.col("n_repeat_words") / words,
            "upper_share": F.col("n_upper") / chars,
        }
    )


def binomial_tail(n: Column, k: Column, rate: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, rate), by the recurrence of the log probabilities."""
    start = F.struct((n * F.log1p(F.lit(-rate))).alias("log_p"), F.exp(n * F.log1p(F.lit(-rate))).alias("sum"))
    step = F.log(F.lit(rate / (1 - rate)))

    def add(acc: Column, i: Column) -> Column:
        log_p = acc["log_p"] + F.log((n - i + 1) / i) + step
        return F.struct(log_p.alias("log_p"), (acc["sum"] + F.exp(log_p)).alias("sum"))

    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(terms, start, add)["sum"]


def _level(rule: str) -> Column:
    """Level g of the grid stands for the cut-off g / GRID."""
    return F.floor(F.col(rule) * GRID + F.lit(1e-9)).cast("int")


def _tried(stats: DataFrame) -> DataFrame:
    """One row per stratum: for each rule the level to try at each step, ``GRID + 1`` for none."""
    levels = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), _level(r).alias("level")) for r in RULES])).alias("r")
    counted = stats.select("stratum", levels).groupBy("stratum", "r.rule", "r.level").agg(F.count("*").alias("c"))
    per_rule = counted.groupBy("stratum", "rule").agg(
        F.sum("c").alias("n"), F.collect_list(F.struct("level", "c")).alias("levels")  # at most GRID + 1 levels
    )

    def reaching(g: Column) -> Column:
        return F.aggregate(F.filter("levels", lambda x: x["level"] >= g), F.lit(0).cast("long"), lambda a, x: a + x["c"])

    tails = F.transform(F.sequence(F.lit(1), F.lit(GRID + 1)), lambda g: F.struct(g.alias("g"), reaching(g).alias("c")))
    steps = F.transform(
        F.array(*[F.lit(x) for x in SEVERITIES]),
        lambda s: F.array_min(F.transform(F.filter("tails", lambda t: (t["c"] <= s * F.col("n")) | (t["g"] > GRID)), lambda t: t["g"])),
    )
    stepped = per_rule.withColumn("tails", tails).select("stratum", "rule", steps.alias("steps"))
    return stepped.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("steps"))).alias(f"steps_{r}") for r in RULES])


def thresholds(stats: DataFrame, good_ids: DataFrame) -> DataFrame:
    """(stratum, rule, n_good, cutoff): texts whose statistic reaches the cut-off are rejected.

    ``stats`` has doc_id, stratum and the rule statistics, ``good_ids`` the good rated ids.
    """
    tried = _tried(stats)
    held = stats.join(good_ids, "doc_id").dropDuplicates(["doc_id"])
    hits = []
    for i in range(len(SEVERITIES)):
        hit = F.lit(False)
        for r in RULES:
            hit = hit | (_level(r) >= F.col(f"steps_{r}")[i])
        hits.append(F.count(F.when(hit, 1)).alias(f"k{i}"))
    counted = held.join(tried, "stratum").groupBy("stratum").agg(F.count("*").alias("n_good"), *hits)
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("step"), F.col(f"k{i}").alias("k")) for i in range(len(SEVERITIES))])).alias("s")
    # One row: the number of strata that have ratings.
    strata = counted.agg(F.greatest(F.count("*"), F.lit(1)).alias("m"))
    tests = counted.select("stratum", "n_good", steps).select("stratum", "n_good", "s.*").join(F.broadcast(strata), F.lit(True))
    tail = F.when(F.col("k") <= F.col("n_good") * MAX_FALSE, binomial_tail(F.col("n_good"), F.col("k"), MAX_FALSE)).otherwise(F.lit(1.0))
    passed = tail <= F.lit(LEVEL) / F.col("m")
    first_failure = F.coalesce(F.min(F.when(~passed, F.col("step"))), F.lit(len(SEVERITIES)))
    used = tests.groupBy("stratum", "n_good").agg((first_failure - 1).alias("step")).where("step >= 0")
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"steps_{r}")[F.col("step")].alias("level")) for r in RULES])).alias("r")
    cuts = used.join(tried, "stratum").select("stratum", "n_good", rules).select("stratum", "r.rule", "n_good", "r.level")
    return cuts.where(F.col("level") <= GRID).select("stratum", "rule", "n_good", (F.col("level") / F.lit(float(GRID))).alias("cutoff"))


def judge(docs: DataFrame, rated: DataFrame) -> DataFrame:
    """The contract's columns for every row of ``docs``, and ``rejected_by``, the first rule that rejects."""
    keep = docs.select("doc_id", F.coalesce(F.concat(F.lit("s"), F.col("lang")), F.lit("n")).alias("stratum"), "text")
    stats = stage(statistics(base_counts(keep, ["doc_id", "stratum"])), "quality-stats")
    good = rated.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t")).where("q = 1 and t = 0")
    cuts = thresholds(stats, good.select("doc_id"))
    # At most one row per stratum.
    wide = stage(cuts.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES]), "quality-cuts")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    by = F.coalesce(*[F.when(F.floor(F.col(r) * GRID + F.lit(1e-9)) / F.lit(float(GRID)) >= F.col(f"cut_{r}"), F.lit(r)) for r in RULES])
    return (
        stats.join(wide, "stratum", "left")
        .withColumn("base_failed", failed)
        .withColumn("rejected_by", by)
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            (~F.col("base_failed") & F.col("rejected_by").isNull()).alias("kept"), "rejected_by",
        )
    )


def op5_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir), labels(spark, sf_dir))


OP5_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('s' || lang, 'n') AS stratum, coalesce(text, '') AS text
  FROM documents
), w AS (
  SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos
  FROM (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d)
), tri AS (
  SELECT rid, pos, word AS a, lead(word, 1) OVER v AS b, lead(word, 2) OVER v AS c FROM w
  WINDOW v AS (PARTITION BY rid ORDER BY pos)
), rep AS (
  SELECT rid, a, b, c FROM tri WHERE c IS NOT NULL GROUP BY rid, a, b, c HAVING count(*) > 1
), cov AS (
  SELECT rid, count(DISTINCT p) AS n_repeat
  FROM (SELECT tri.rid, unnest([pos, pos + 1, pos + 2]) AS p FROM tri JOIN rep USING (rid, a, b, c)) GROUP BY rid
), wc AS (
  SELECT rid, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY rid
), ln AS (
  SELECT rid, count(*) AS n_lines, count(DISTINCT line) AS n_distinct
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
), counts AS (
  SELECT doc_id, stratum, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(n_lines - n_distinct, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat, 0)::BIGINT AS n_repeat_words,
         coalesce(n_lines, 0)::BIGINT AS n_lines, len(regexp_extract_all(text, '[A-Z]'))::BIGINT AS n_upper
  FROM d LEFT JOIN wc USING (rid) LEFT JOIN ln USING (rid) LEFT JOIN cov USING (rid)
), stats AS (
  SELECT *, floor(40 * (n_symbols / greatest(word_chars, 1)::DOUBLE) + 1e-9) AS l1,
         floor(40 * (n_dup_lines / greatest(n_lines, 1)::DOUBLE) + 1e-9) AS l2,
         floor(40 * (n_repeat_words / greatest(n_words, 1)::DOUBLE) + 1e-9) AS l3,
         floor(40 * (n_upper / greatest(word_chars, 1)::DOUBLE) + 1e-9) AS l4
  FROM counts
), good AS (
  SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1 AND max(toxic) = 0
), every AS (
  SELECT stratum, unnest([1, 2, 3, 4]) AS rule, unnest([l1, l2, l3, l4]) AS lev FROM stats
), tails AS (
  SELECT stratum, rule, g, count(*) AS n, count(*) FILTER (WHERE lev >= g) AS c
  FROM every, range(1, 42) AS r(g) GROUP BY stratum, rule, g
), tried AS (
  SELECT stratum, rule, s.step, min(g) FILTER (WHERE c <= s.share * n OR g > 40) AS cut
  FROM tails, (SELECT unnest(range(11)) AS step, unnest({severities}) AS share) s GROUP BY stratum, rule, s.step
), steps AS (
  SELECT stratum, step, max(cut) FILTER (WHERE rule = 1) AS c1, max(cut) FILTER (WHERE rule = 2) AS c2,
         max(cut) FILTER (WHERE rule = 3) AS c3, max(cut) FILTER (WHERE rule = 4) AS c4
  FROM tried GROUP BY stratum, step
), tests AS (
  SELECT t.stratum, step, count(*) AS n, count(*) FILTER (WHERE l1 >= c1 OR l2 >= c2 OR l3 >= c3 OR l4 >= c4) AS k
  FROM (SELECT DISTINCT ON (doc_id) stats.* FROM stats JOIN good USING (doc_id)) t JOIN steps USING (stratum) GROUP BY t.stratum, step
), verdicts AS (
  SELECT stratum, step,
         CASE WHEN k <= n * 0.02 THEN list_sum(list_transform(range(0, k + 1), lambda i:
           exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.02) + (n - i) * ln(0.98))))
         ELSE 1.0 END <= 0.05 / (SELECT count(DISTINCT stratum) FROM tests) AS passed
  FROM tests
), used AS (
  SELECT stratum, coalesce(min(step) FILTER (WHERE NOT passed), 11) - 1 AS step FROM verdicts GROUP BY stratum
), wide AS (
  SELECT stratum, c1, c2, c3, c4 FROM steps JOIN used USING (stratum, step)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         CASE WHEN l1 >= c1 THEN 'symbol_share' WHEN l2 >= c2 THEN 'dup_line_share'
              WHEN l3 >= c3 THEN 'repeat_share' WHEN l4 >= c4 THEN 'upper_share' END AS rejected_by
  FROM stats LEFT JOIN wide USING (stratum)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rejected_by IS NULL AS kept, rejected_by
FROM judged
""".replace("{severities}", str(list(SEVERITIES)))
