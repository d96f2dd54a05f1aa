"""Regular-expression matches with their positions, as one array per text and no Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: positions are summed in runs of this many matches, so that n matches take n * sqrt(n) steps or fewer
_RUN = 256
_SPANS = "array<struct<s:int,e:int,v:string>>"


def _runs(items: Column) -> Column:
    last = F.floor((F.size(items) - 1) / _RUN)
    starts = F.sequence(F.lit(0).cast("long"), last)
    return F.when(F.size(items) > 0, F.transform(starts, lambda j: F.slice(items, (j * _RUN + 1).cast("int"), _RUN)))


def _placed(run: Column) -> Column:
    """Spans of one run, from its own start, and the length of the run."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))
    return F.aggregate(run, start, lambda acc, x: F.struct(
        (acc["at"] + x["g"] + x["n"]).alias("at"),
        F.concat(acc["out"], F.array(F.struct((acc["at"] + x["g"]).alias("s"), (acc["at"] + x["g"] + x["n"]).alias("e"), x["v"].alias("v")))).alias("out"),
    ))


def with_spans(df: DataFrame, patterns: dict[str, tuple[str, Column]], text: str = "text") -> DataFrame:
    """Adds for each name an array of (start, end, value) of the pattern's matches.

    Matches are leftmost and do not overlap; positions count code points, the end is exclusive.
    ``patterns`` maps a name to a Java pattern and a cheap condition without which it cannot
    match.  Between two matches lies one piece of the split text, so positions are running sums
    of the pieces' and matches' lengths.
    """
    kept = list(df.columns)
    never = F.array().cast("array<struct<g:int,n:int,v:string>>")
    items = {}
    for name, (pattern, possible) in patterns.items():
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        pieces = F.split(F.col(text), pattern, -1)
        pairs = F.zip_with(
            F.slice(pieces, F.lit(1), F.size(found)), found,
            lambda p, v: F.struct(F.length(p).alias("g"), F.length(v).alias("n"), v.alias("v")),
        )
        items[f"_i_{name}"] = F.when(possible, pairs).otherwise(never)
    df = df.withColumns(items)
    runs = {f"_r_{name}": _runs(F.col(f"_i_{name}")) for name in patterns}
    local = {f"_l_{name}": F.transform(F.col(f"_r_{name}"), _placed) for name in patterns}
    df = df.withColumns(runs).withColumns(local)
    spans = []
    for name in patterns:
        parts = F.col(f"_l_{name}")
        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        offsets = F.aggregate(parts, begin, lambda acc, x: F.struct(
            (acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]
        moved = F.zip_with(parts, offsets, lambda part, o: F.transform(part["out"], lambda x: F.struct((x["s"] + o).alias("s"), (x["e"] + o).alias("e"), x["v"].alias("v"))))
        spans.append(F.coalesce(F.flatten(moved), F.array().cast(_SPANS)).alias(name))
    return df.select(*kept, *spans)


def labelled(spans: Column, kind: str, order: int, score: Column | float = 1.0) -> Column:
    """The spans as (start, order of the kind, end, kind, score), which sorts as reports list them."""
    return F.transform(spans, lambda x: F.struct(
        x["s"].alias("s"), F.lit(order).alias("o"), x["e"].alias("e"), F.lit(kind).alias("kind"),
        (score(x) if callable(score) else F.lit(float(score))).cast("double").alias("score")))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")
