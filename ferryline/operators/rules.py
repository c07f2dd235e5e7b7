"""First failing rule of a row, as an expression."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REJECT_COLUMN = "_reject_column"
REJECT_REASON = "_reject_reason"
_RULE = "_reject_rule"


class Rule(NamedTuple):
    column: str | None  # None: the rule is about the whole row
    reason: str
    failed: Column


def first_failure(rules: list[Rule], offset: int = 0) -> Column:
    """Number of the first rule that a row fails, counted from ``offset``; else NULL."""
    first = F.when(rules[0].failed, offset)
    for i, rule in enumerate(rules[1:], offset + 1):
        first = first.when(rule.failed, i)
    return first


def named_failure(number: Column, rules: list[Rule]) -> list[Column]:
    """Column and reason behind a rule number, NULL for rows that pass."""
    columns = F.array(*[F.lit(r.column).cast("string") for r in rules])
    reasons = F.array(*[F.lit(r.reason) for r in rules])
    return [
        F.get(columns, number).alias(REJECT_COLUMN),
        F.get(reasons, number).alias(REJECT_REASON),
    ]


def with_first_failure(df: DataFrame, rules: list[Rule], output: list[Column]) -> DataFrame:
    """``output`` plus the column and reason of the first rule each row fails."""
    if not rules:
        nothing = F.lit(None).cast("string")
        return df.select(*output, nothing.alias(REJECT_COLUMN), nothing.alias(REJECT_REASON))
    numbered = df.withColumn(_RULE, first_failure(rules))
    return numbered.select(*output, *named_failure(F.col(_RULE), rules))
