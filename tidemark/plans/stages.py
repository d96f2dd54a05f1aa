"""The stages of a campaign: label, features, report, train and score."""

from __future__ import annotations

import json
import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..operators import drift, evaluation, features, group_features, labels, sampling
from ..operators import scoring, selection, training
from ..sources import panels as sources
from ..sources.staging import stage, staged
from ..spec import BANK_PANEL, PanelSpec
from . import sql_steps

logger = logging.getLogger(__name__)


def label_stage(
    spark: SparkSession, source: str, target: str, spec: PanelSpec = BANK_PANEL, unique_key: bool = True
) -> None:
    """Read a raw panel, add the attrition label, write it by period.

    ``unique_key=False`` labels by joins, which also suits panels with repeated keys.
    """
    raw = sources.read_panel(spark, source, spec)
    raw = raw.withColumn(spec.period, F.col(spec.period).cast("int"))
    label = labels.attrition_label if unique_key else labels.label_by_join
    sources.write_parquet(label(raw, spec), target, spec.period)


def build_features(
    df: DataFrame, spec: PanelSpec = BANK_PANEL, generation: str = "steps"
) -> DataFrame:
    """``steps``: the five steps; ``sql``: the same as SQL; ``v2`` and ``v3``: generated ones."""
    if generation == "steps":
        return features.features_full(df, spec)
    if generation == "sql":
        return sql_steps.run_standard_steps(df, spec)
    if generation == "v2":
        return group_features.features_v2(df, spec)
    if generation == "v3":
        return group_features.features_v3(df, spec)
    raise ValueError(f"unknown feature generation {generation!r}")


def feature_stage(
    spark: SparkSession, source: str, target: str, spec: PanelSpec = BANK_PANEL,
    generation: str = "v3",
) -> None:
    panel = sources.read_panel(spark, source, spec)
    sources.write_parquet(build_features(panel, spec, generation), target, spec.period)


@dataclass(frozen=True)
class Report:
    drift: DataFrame
    outliers: DataFrame
    to_drop: DataFrame


def quality_report(df: DataFrame, spec: PanelSpec = BANK_PANEL) -> Report:
    """Drift and outliers of every numeric column per period.  ``df``: a table."""
    columns = group_features.numeric_columns(df, [*spec.key, spec.target])
    psi = drift.psi_by_column_period(df, spec.period, columns)
    rates = drift.outlier_rate_by_column_period(df, spec.period, columns)
    by_drift = drift.drift_by_period(psi, spec.period, len(columns))
    by_outliers = drift.outlier_by_period(rates, spec.period, len(columns))
    return Report(by_drift, by_outliers, drift.periods_to_drop(by_drift, by_outliers, spec.period))


@dataclass(frozen=True)
class Campaign:
    """Settings of a training and scoring run."""

    future: Sequence[int]
    train: Sequence[int] | None = None
    seeds: Sequence[int] = (fixed.FOLD_SEED,)
    contacts: int = fixed.CONTACTS
    canaries: int = 0
    undersample: float | None = fixed.UNDERSAMPLE_FACTOR
    label: str = "is_gone_in_two"
    drop: Sequence[str] = (*fixed.LEAK_COLUMNS, *fixed.CANARY_BLOCK_COLUMNS)
    parallelism: int = 4
    params: dict = field(default_factory=dict)
    #: leave out the periods that the drift and outlier report names, except the future ones
    drop_reported: bool = False


@dataclass(frozen=True)
class CampaignResult:
    """``profit``: of the contacts; ``peak``: the maximum of the whole curve and its position."""

    scored: DataFrame
    profit: DataFrame
    peak: DataFrame
    models: list
    manifest: training.Manifest


def in_sample_metrics(models: Sequence, matrix: training.TrainMatrix, spec: PanelSpec) -> dict:
    """Log loss and confusion matrix of an ensemble on its training rows."""
    scored = scoring.predict(matrix.frame, spec, models, matrix.features)
    labels_of = matrix.frame.select(*spec.key, F.col(training.LABEL).alias("label"))
    with staged(scored.join(labels_of, spec.key)) as table:
        flagged = table.withColumn("flag", scoring.threshold_flag(F.col(scoring.SCORE)))
        cells = evaluation.confusion_matrix(flagged, "flag", "label").collect()
        loss = evaluation.log_loss(table, scoring.SCORE, "label").first()["log_loss"]
    return {"log_loss": loss, "confusion": {f"{r['actual']}{r['predicted']}": r["n"] for r in cells}}


def train_and_score(df: DataFrame, spec: PanelSpec, campaign: Campaign) -> CampaignResult:
    """Targets, noise columns, balanced sample, seed ensemble, contact list and its profit.

    ``df`` is a feature table with a target.  With noise columns, features that matter less
    than noise are removed before the ensemble is trained.
    """
    df = labels.class_weights(labels.binary_targets(df, spec.target), spec.target)
    if campaign.canaries:
        df = sampling.canary_columns(df, spec, campaign.canaries)
    if campaign.drop_reported:
        reported = quality_report(stage(df.drop("row_weight", "is_gone_in_two", "is_leaver")), spec).to_drop
        bad = {r[spec.period] for r in reported.collect()} - set(campaign.future)
        df = df.filter(~F.col(spec.period).isin(sorted(bad))) if bad else df
    available = selection.distinct_periods(df, spec.period)
    periods = selection.resolve_periods(available, campaign.train, campaign.future)
    train, future = selection.train_future_split(df, spec.period, periods)
    if campaign.undersample is not None:
        train = sampling.undersample_majority(train, spec, campaign.undersample)
    matrix = training.train_matrix(
        train, spec, periods.train, campaign.label, "row_weight", "is_gone_in_two",
        [*campaign.drop, "is_gone_in_two", "is_leaver"],
    )
    matrix = training.TrainMatrix(stage(matrix.frame), matrix.features)
    if campaign.canaries:
        importance = training.canary_importance_filter(matrix, **campaign.params)
        kept = {r["feature"] for r in importance.filter("keep").collect()}
        names = [f for f in matrix.features if f in kept]
        matrix = training.TrainMatrix(matrix.frame, names or matrix.features)
    models = training.train_seed_ensemble(
        matrix, campaign.seeds, campaign.parallelism, **campaign.params
    )
    scores = stage(scoring.predict(future, spec, models, matrix.features, strict=True))
    scored = scoring.top_n_flag(scores, spec, campaign.contacts)
    truth = future.select(*spec.key, "is_gone_in_two")
    if evaluation.truth_is_missing(truth, scores, spec, "is_gone_in_two"):
        logger.warning("no labels for the periods %s", periods.future)
    known = stage(evaluation.with_truth(scores, truth, spec, "is_gone_in_two"))
    profit = evaluation.profit_top_n(
        known, scoring.SCORE, "is_gone_in_two", spec.key, campaign.contacts
    )
    peak = evaluation.profit_peak(
        evaluation.profit_curve(known, scoring.SCORE, "is_gone_in_two", spec.key)
    )
    manifest = training.Manifest(
        matrix.features, list(campaign.seeds), list(periods.train), dict(campaign.params),
        in_sample_metrics(models, matrix, spec),
    )
    return CampaignResult(scored, profit, peak, models, manifest)


def campaign_stage(
    spark: SparkSession, source: str, target: str, campaign: Campaign, spec: PanelSpec = BANK_PANEL
) -> CampaignResult:
    """Train on a feature table, write models, detail and contact list under ``target``."""
    result = train_and_score(sources.read_panel(spark, source, spec), spec, campaign)
    training.save_ensemble(result.models, result.manifest, f"{target}/models")
    sources.write_predictions(result.scored, spec, f"{target}/predictions")
    return result


def score_stage(
    spark: SparkSession, source: str, models: str, target: str, period: int,
    contacts: int = fixed.CONTACTS, spec: PanelSpec = BANK_PANEL, strict: bool = True,
) -> DataFrame:
    """Score one period of a feature table with a stored ensemble; write detail and contact list.

    The detail is sorted by rank; rank and contact flag come from the same order.
    """
    ensemble, manifest = training.load_ensemble(models)
    rows = selection.filter_period(sources.read_panel(spark, source, spec), spec.period, period)
    scores = stage(scoring.predict(rows, spec, ensemble, manifest.features, strict))
    ranked = scoring.rank_scores(scores, spec)
    scored = ranked.withColumn("contact", (F.col("rank_desc") <= contacts).cast("int"))
    sources.write_predictions(scored.orderBy("rank_desc"), spec, target)
    return scored


def search_stage(
    matrix: training.TrainMatrix, spec: PanelSpec, target: str, seeds: Sequence[int] = (fixed.FOLD_SEED,),
    folds: int = fixed.FOLDS, trials: int = fixed.SEARCH_TRIALS, early_stop: int | None = fixed.EARLY_STOP,
    space: dict[str, tuple] = fixed.SEARCH_SPACE, parallelism: int = 4, **params,
) -> training.Manifest:
    """Search, cross-validate the winner by round, refit it at its best round, and store it.

    ``matrix.frame``: a table or staged frame.  The manifest says the winner's parameters, best
    round, profits of the cross-validation and in-sample metrics.
    """
    search = training.param_search(matrix, spec, trials, folds, space=space, parallelism=parallelism, **params)
    winner = next(r for r in search.collect() if r["is_best"])
    chosen = {**params, **json.loads(winner["params"])}
    rounds = training.profit_cv(matrix, spec, folds, early_stop=early_stop, parallelism=parallelism, **chosen)
    best = next(r for r in rounds.collect() if r["is_best"])
    chosen["maxIter"] = best["round"]
    models = training.train_seed_ensemble(matrix, seeds, parallelism, **chosen)
    metrics = {
        "search_profit": winner["mean_profit"], "best_round": best["round"], "cv_profit": best["mean_profit"],
        "cv_profit_std": best["std_profit"], **in_sample_metrics(models, matrix, spec),
    }
    manifest = training.Manifest(matrix.features, list(seeds), [], chosen, metrics)
    training.save_ensemble(models, manifest, target)
    return manifest
