"""Scoring a period: probabilities, flags, ranks, contact lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.scalars import clip
from ..sources.staging import stage
from ..spec import PanelSpec
from .nth import nth_row, up_to
from .ranking import rank_rows
from .selection import align_features, filter_period

SCORE = "score"


def clip_probability(p: Column) -> Column:
    margin = fixed.PROBABILITY_MARGIN
    return clip(p, margin, 1 - margin)


def threshold_flag(p: Column, threshold: float = fixed.DECISION_THRESHOLD) -> Column:
    return (p >= threshold).cast("int")


def mean_score(scores: Sequence[Column]) -> Column:
    """Mean of the clipped scores of several models, clipped again."""
    clipped = [clip_probability(s) for s in scores]
    return clip_probability(reduce(lambda a, b: a + b, clipped) / float(len(clipped)))


def model_score(df: DataFrame, model, name: str) -> DataFrame:
    """Add the positive-class probability of a fitted model and drop its helper columns."""
    kept = df.columns
    scored = model.transform(df)
    return scored.select(*kept, vector_to_array("probability")[1].alias(name))


def predict(
    df: DataFrame, spec: PanelSpec, models: Sequence, features: Sequence[str], strict: bool = False
) -> DataFrame:
    """(id, period, score) with the mean score of one or several models.

    The models share their features, so the rows are prepared once for all of them.
    """
    scored = align_features(df, features, keep=spec.key, strict=strict)
    for step in models[0].stages[:-1]:
        scored = step.transform(scored)
    scored = scored.select(*spec.key, "features")
    names = [f"_model{i}" for i in range(len(models))]
    for model, name in zip(models, names):
        scored = model_score(scored, model.stages[-1], name)
    return scored.select(*spec.key, mean_score([F.col(n) for n in names]).alias(SCORE))


def rank_scores(scores: DataFrame, spec: PanelSpec, rank: str = "rank_desc") -> DataFrame:
    """Rank 1..n by score descending, ties by id and period."""
    return rank_rows(scores, SCORE, spec.key, descending=True, row=rank)


def scored_table(
    scores: DataFrame, spec: PanelSpec, threshold: float = fixed.DECISION_THRESHOLD
) -> DataFrame:
    """Add the contact flag and the rank.  ``scores``: a table or staged frame."""
    return rank_scores(
        scores.select("*", threshold_flag(F.col(SCORE), threshold).alias("contact")), spec
    )


def score_period(
    df: DataFrame,
    spec: PanelSpec,
    period: int,
    models: Sequence,
    features: Sequence[str],
    threshold: float = fixed.DECISION_THRESHOLD,
    strict: bool = False,
) -> DataFrame:
    """Score one period with one model or an ensemble: (id, period, score, contact, rank).

    The scores are staged before they are ranked, so each model runs once per row.
    """
    rows = filter_period(df, spec.period, period, must_exist=False)
    scores = stage(predict(rows, spec, models, features, strict))
    if scores.isEmpty():
        raise ValueError(f"no rows for period {period}")
    return scored_table(scores, spec, threshold)


def sort_scores(scores: DataFrame, spec: PanelSpec) -> DataFrame:
    """Global order by score (range-partitioned sort), rows without one last."""
    value = F.col(SCORE)
    return scores.orderBy(F.isnan(F.coalesce(value, F.lit(float("nan")))), value.desc_nulls_last(), *spec.key)


def head_report(scores: DataFrame, spec: PanelSpec, rows: int = 10) -> DataFrame:
    """The first rows of the ranking."""
    return sort_scores(scores, spec).limit(rows)


def top_n_flag(
    scores: DataFrame, spec: PanelSpec, n: int = fixed.CONTACTS, name: str = "contact"
) -> DataFrame:
    """1 for the first ``n`` rows by score (all rows when there are fewer), 0 for the rest.

    Rows without a score, NULL or NaN, come last.  The n-th row is found by counting, then the flag is
    a filter on the input: nothing is sorted or exchanged.  ``scores``: a table or staged frame.
    """
    order = [(SCORE, True), *((k, False) for k in spec.key)]
    if n <= 0:
        return scores.select("*", F.lit(0).alias(name))
    last = nth_row(scores, order, n)
    return scores.select("*", (F.lit(1) if last is None else up_to(scores, order, last).cast("int")).alias(name))


def simple_export(scores: DataFrame, spec: PanelSpec, flag: str = "contact") -> DataFrame:
    """(id, Predicted): the file that goes out."""
    return scores.select(spec.id, F.col(flag).cast("int").alias("Predicted"))
