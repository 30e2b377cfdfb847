"""Transparent additive scores: rules as data, with the reasons beside the number."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """`when` is a SQL condition; a row that meets it gets `points`, explained by `reason`."""

    when: str
    points: int
    reason: str


def with_score(
    df: DataFrame,
    rules: Sequence[Rule],
    bands: Sequence[tuple[int, str]],
    lowest: str,
    score: str = "risk_score",
    reasons: str = "risk_reasons",
    band: str = "risk_band",
) -> DataFrame:
    """Add the summed points, the reasons that applied and the first band whose minimum is reached."""
    points = F.lit(0)
    for rule in rules:
        points = points + F.when(F.expr(rule.when), rule.points).otherwise(0)
    why = F.array_compact(F.array(*[F.when(F.expr(rule.when), F.lit(rule.reason)) for rule in rules]))
    label = F.lit(lowest)
    for minimum, name in sorted(bands):
        label = F.when(F.col(score) >= minimum, name).otherwise(label)
    return df.withColumn(score, points).withColumn(reasons, why).withColumn(band, label)
