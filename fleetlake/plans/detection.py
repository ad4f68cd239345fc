"""Silver to scored readings and incidents: fit, score, flag, merge."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetlake.functions.rules import READINGS_PER_DAY
from fleetlake.operators.evaluation import evaluate_by_server, evaluate_detector, evaluate_rules
from fleetlake.operators.forest import (
    CONTAMINATION,
    SEED,
    TREES,
    cutoff,
    fit_forest,
    flag,
    load_model,
    save_model,
    score,
)
from fleetlake.operators.incidents import build_events, finish_events
from fleetlake.operators.quality import orphans
from fleetlake.operators.scaling import FEATURES, apply_scalers, build_features, fit_scalers, unscaled_servers
from fleetlake.operators.serving import serving_anomalies
from fleetlake.operators.sketches import day_sketches, scalers_from_sketches
from fleetlake.session import stage
from fleetlake.sources.tables import ANOMALY_TYPES, conform, publish, write_events, write_scores, write_table


@dataclass(frozen=True)
class Detection:
    """What one run yields; every frame reads a written table, so it is cheap to use again."""

    scored: DataFrame
    events: DataFrame
    scalers: DataFrame
    forest: DataFrame
    cut: float


def scale(silver: DataFrame, cap: float | None = None, exact: bool = True) -> tuple[DataFrame, DataFrame]:
    """Features with their z-scores, and the scalers fitted on them, exactly or from sketches in one pass.

    The features are written once, since fitting reads them several times. The z-scores are
    not: they are a projection of the features beside one scaler row per server.
    """
    featured = stage(build_features(silver), "features")
    if exact:
        fitted = fit_scalers(featured)
    else:
        days = day_sketches(featured.withColumn("dt", F.to_date("timestamp")))
        fitted = scalers_from_sketches(days).select("server_id", "feature", "median", "scale")
    scalers = stage(fitted, "scalers")
    return apply_scalers(featured, scalers, cap=cap), scalers


def detect(
    silver: DataFrame,
    trees: int = TREES,
    contamination: float = CONTAMINATION,
    seed: int = SEED,
    cap: float | None = None,
    exact: bool = True,
) -> Detection:
    """Fit on ``silver`` and score the same readings."""
    z, scalers = scale(silver, cap, exact)
    forest = stage(fit_forest(z, trees=trees, seed=seed), "forest")
    scored = stage(score(z, forest), "scored")
    found = cutoff(scored, contamination=contamination).first()
    # Nothing could be scored: no reading is flagged and there are no incidents.
    cut = float("nan") if found is None or found["cut"] is None else found["cut"]
    flagged = flag(scored, cut=cut)
    events = stage(finish_events(build_events(flagged)), "events")
    return Detection(flagged, events, scalers, forest, cut)


def run_detection(silver: DataFrame, out: str, servers: DataFrame | None = None, **options) -> Detection:
    """Detect, and keep scores, incidents, the serving table and the model under ``out``.

    ``report`` holds servers without scalers, incidents of servers missing in the dimension (if
    one is given), and detector and rules against ground truth (if the readings carry it).
    """
    result = detect(silver, **options)
    write_scores(result.scored, f"{out}/anomaly_results", FEATURES)
    write_events(result.events, f"{out}/anomaly_events")
    publish(conform(serving_anomalies(result.events), ANOMALY_TYPES), f"{out}/anomalies")
    write_table(unscaled_servers(result.scored, result.scalers), f"{out}/report/unscaled_servers")
    if servers is not None:
        write_table(orphans(result.events, servers, "server_id"), f"{out}/report/orphans")
    if "is_injected_anomaly" in silver.columns:
        write_table(evaluate_detector(result.scored), f"{out}/report/detector")
        write_table(evaluate_rules(result.scored), f"{out}/report/rules")
        write_table(evaluate_by_server(result.scored), f"{out}/report/by_server")
    save_model(
        result.scalers,
        result.forest,
        f"{out}/model",
        features=",".join(FEATURES),
        contamination=options.get("contamination", CONTAMINATION),
        cut=result.cut,
    )
    return result


def recent(silver: DataFrame, rows: int = READINGS_PER_DAY - 1) -> DataFrame:
    """The last readings of each server, as many as a rolling slope looks back on."""
    newest = F.row_number().over(W.partitionBy("server_id").orderBy(F.desc("timestamp")))
    return silver.withColumn("_age", newest).filter(F.col("_age") <= rows).drop("_age")


def score_new(silver: DataFrame, model_path: str, earlier: DataFrame | None = None) -> DataFrame:
    """Score later readings with a saved model, and flag them if the model kept its cut-off.

    ``earlier`` readings (all of them, or those of some days) give the slopes their history;
    only the new ones are returned. Without them each server's first slopes are 0.
    """
    scalers, forest, settings = load_model(silver.sparkSession, model_path)
    rows = silver.withColumn("_new", F.lit(True))
    if earlier is not None:
        rows = rows.unionByName(recent(earlier).select(*silver.columns).withColumn("_new", F.lit(False)))
    fresh = build_features(rows).filter("_new").drop("_new")
    scored = score(apply_scalers(fresh, scalers), forest)
    return flag(scored, cut=float(settings["cut"])) if "cut" in settings else scored
