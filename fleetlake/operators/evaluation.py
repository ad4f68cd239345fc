"""Detector and rules against ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.rules import count_if, hour_in, is_rule_anomaly, ratio, rounded, truth


def evaluate(
    df: DataFrame, predicted: Column, truth_column: str = "is_injected_anomaly"
) -> DataFrame | None:
    """Confusion counts, precision, recall and F1 (0 where undefined), as one row.

    Readings without a prediction are counted as ``unscored`` and enter no other count.
    Returns ``None`` if the readings carry no ground truth.
    """
    if truth_column not in df.columns:
        return None
    real = truth(truth_column)
    counts = df.agg(
        count_if(predicted & real).alias("tp"),
        count_if(predicted & ~real).alias("fp"),
        count_if(~predicted & real).alias("fn"),
        count_if(~predicted & ~real).alias("tn"),
        count_if(predicted.isNull()).alias("unscored"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")

    def share(numerator: Column, denominator: Column) -> Column:
        return rounded(F.coalesce(ratio(numerator, denominator), F.lit(0.0)), 3)

    return counts.withColumns(
        {
            "precision": share(tp, tp + fp),
            "recall": share(tp, tp + fn),
            "f1": share(2 * tp, 2 * tp + fp + fn),
        }
    )


def evaluate_detector(scored: DataFrame) -> DataFrame | None:
    return evaluate(scored, F.col("is_anomaly") == 1)


def evaluate_rules(df: DataFrame) -> DataFrame | None:
    return evaluate(df, is_rule_anomaly())


def evaluate_by_server(scored: DataFrame) -> DataFrame:
    """Per server, true, flagged and hit readings, rule flags and recall."""
    flagged = F.col("is_anomaly") == 1
    counts = scored.groupBy("server_id").agg(
        count_if(truth()).alias("injected_truth"),
        count_if(flagged).alias("model_flagged"),
        count_if(flagged & truth()).alias("model_tp"),
        count_if(is_rule_anomaly()).alias("rule_flagged"),
    )
    recall = ratio(100 * F.col("model_tp"), F.col("injected_truth"))
    return counts.withColumn("model_recall_pct", rounded(recall, 1)).orderBy("server_id")


def false_positives_by_hour(scored: DataFrame, tz: str = "Asia/Singapore") -> DataFrame:
    """False alarms by local hour."""
    wrong = scored.filter((F.col("is_anomaly") == 1) & ~truth())
    hours = wrong.groupBy(hour_in(F.col("timestamp"), tz).alias("hour"))
    return hours.agg(F.count(F.lit(1)).alias("n")).orderBy("hour")


def flag_rate(scored: DataFrame) -> DataFrame:
    """Flagged readings, all readings and their share in percent."""
    counts = scored.agg(
        count_if(F.col("is_anomaly") == 1).alias("flagged"), F.count(F.lit(1)).alias("readings")
    )
    share = ratio(100 * F.col("flagged"), F.col("readings"))
    return counts.withColumn("flagged_percent", rounded(share, 2))


def top_scores(scored: DataFrame, n: int = 10, columns: list[str] | None = None) -> DataFrame:
    """The readings with the highest scores."""
    keys = ["timestamp", "server_id", "anomaly_score"]
    order = [F.desc("anomaly_score"), F.col("server_id"), F.col("timestamp")]
    return scored.select(*keys, *(columns or [])).orderBy(*order).limit(n)


def first_results(scored: DataFrame, n: int = 10) -> DataFrame:
    """The first results in time order."""
    return scored.select("timestamp", "server_id", "result").orderBy("timestamp", "server_id").limit(n)
