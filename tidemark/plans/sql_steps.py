"""Run an ordered list of SQL steps over a registered panel."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..operators.features import tenure_rankings
from ..spec import PanelSpec

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
SQL_DIR = Path(__file__).parent / "sql"


@dataclass(frozen=True)
class Step:
    """A SELECT template whose result is known to later steps as ``name``."""

    name: str
    template: str


def read_step(path: str | Path) -> Step:
    path = Path(path)
    if not path.is_file():
        raise FileNotFoundError(f"no SQL step at {path}")
    return Step(path.stem, path.read_text(encoding="utf-8"))


def standard_steps() -> list[Step]:
    """The five feature steps as SQL.

    They expect the columns of ``tenure_rankings`` in the base table: SQL alone would rank a
    whole period in one window group.
    """
    return [read_step(p) for p in sorted(SQL_DIR.glob("*.sql"))]


def parameters(spec: PanelSpec, base_table: str) -> dict[str, str]:
    return {
        "base_table": base_table,
        "id_col": spec.id,
        "period_col": spec.period,
        "target_col": spec.target,
        **spec.roles,
    }


def render(template: str, params: Mapping[str, str]) -> str:
    """Fill ``{name}`` placeholders with identifiers."""
    for name, value in params.items():
        if not _IDENTIFIER.fullmatch(value):
            raise ValueError(f"{name} is not an identifier: {value!r}")
    return template.format(**params)


def run_steps(
    spark: SparkSession, steps: Sequence[Step], params: Mapping[str, str]
) -> DataFrame:
    """Register each step's result as a temporary view; the last one is the result.

    Nothing is executed in between: Catalyst optimises all steps as one plan.
    """
    if not steps:
        raise ValueError("no SQL steps given")
    for step in steps:
        result = spark.sql(render(step.template, params))
        result.createOrReplaceTempView(step.name)
    return result


def run_standard_steps(df: DataFrame, spec: PanelSpec, base_table: str = "panel_base") -> DataFrame:
    """Register the ranked panel and run the five steps.  ``df``: a table or staged frame."""
    tenure_rankings(df, spec).createOrReplaceTempView(base_table)
    return run_steps(df.sparkSession, standard_steps(), parameters(spec, base_table))
