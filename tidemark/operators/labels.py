"""Attrition labels, binary targets and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.periods import period_add, period_position
from ..functions.scalars import flag
from ..spec import PanelSpec


def _class_of(next_present: Column, second_present: Column) -> Column:
    return (
        F.when(~next_present, fixed.GONE_NEXT)
        .when(~second_present, fixed.GONE_IN_TWO)
        .otherwise(fixed.STAYS)
    )


def attrition_label(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Add the target: gone next period, gone in two, or stays.

    An entity's periods are unique, so its presence at t+1 and t+2 shows in the next two
    rows of its history; one window replaces two joins on the key.  The last periods of
    the panel are right-censored and labelled as gone, as in the join form.
    """
    history = spec.history.rows
    position = period_position(spec.period, spec.granularity)

    def present(k: int) -> Column:
        # t+k is among the next k rows: histories may have gaps.
        hits = [F.lead(position, j).over(history) == position + k for j in range(1, k + 1)]
        found = hits[0]
        for hit in hits[1:]:
            found = F.coalesce(found, F.lit(False)) | F.coalesce(hit, F.lit(False))
        return F.coalesce(found, F.lit(False))

    return df.select("*", _class_of(present(1), present(2)).alias(spec.target))


def presence(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Distinct (entity, period) pairs."""
    return df.select(*spec.key).distinct()


def label_by_join(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """The same label from two left joins on presence, then merged back on the key.

    Also right for panels in which a key occurs several times: the label side is
    distinct, so no row of the panel is multiplied.
    """
    here = presence(df, spec)

    def at(k: int, name: str) -> DataFrame:
        return here.select(
            spec.id,
            period_add(spec.period, -k, spec.granularity)
            .cast(df.schema[spec.period].dataType)
            .alias(spec.period),
            F.lit(True).alias(name),
        )

    labels = (
        here.join(at(1, "_next"), spec.key, "left")
        .join(at(2, "_second"), spec.key, "left")
        .select(
            *spec.key,
            _class_of(
                F.coalesce("_next", F.lit(False)), F.coalesce("_second", F.lit(False))
            ).alias(spec.target),
        )
    )
    return df.drop(spec.target).join(labels, spec.key, "left")


def binary_targets(
    df: DataFrame,
    target: str,
    campaign: str = "is_gone_in_two",
    leaver: str = "is_leaver",
    only_missing: bool = False,
) -> DataFrame:
    """Add two 0/1 targets: gone in two periods; anything but "stays" (NULL counts as 1).

    With ``only_missing`` a target column that exists already is kept.
    """
    if target not in df.columns:
        raise KeyError(f"target column {target!r} is missing")
    made = {
        campaign: flag(F.col(target) == fixed.GONE_IN_TWO),
        leaver: F.when(F.col(target) == fixed.STAYS, 0).otherwise(1),
    }
    if only_missing:
        made = {name: value for name, value in made.items() if name not in df.columns}
    return df.withColumns(made)


def class_weights(
    df: DataFrame,
    target: str,
    weight: str = "row_weight",
    weights: dict[str, float] = fixed.CLASS_WEIGHTS,
    other: float = fixed.OTHER_WEIGHT,
    only_missing: bool = False,
) -> DataFrame:
    """Add the row weight of each class; every other value and NULL gets ``other``."""
    if only_missing and weight in df.columns:
        return df
    value = F.lit(float(other))
    for name, w in weights.items():
        value = F.when(F.col(target) == name, F.lit(float(w))).otherwise(value)
    return df.withColumn(weight, value)


def default_weight(df: DataFrame, weight: str = "row_weight") -> DataFrame:
    """Add a weight of 1.0 when there is none."""
    return df if weight in df.columns else df.withColumn(weight, F.lit(1.0))
