"""Quality-flag rules that check the column type before they build an expression.

Indicator fields arrive as text on some tables and boolean on others. Mixing the
two passes analysis and fails on the first row, so the check is made here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F
from pyspark.sql.types import BooleanType, DataType, StringType, StructType

Rule = Callable[[StructType], Column]


def _typed(schema: StructType, name: str, expected: type[DataType]) -> Column:
    actual = schema[name].dataType
    if not isinstance(actual, expected):
        raise TypeError(f"{name} is {actual.simpleString()}, the rule needs {expected.typeName()}")
    return F.col(name)


def bool_true(name: str) -> Rule:
    return lambda schema: F.coalesce(_typed(schema, name, BooleanType), F.lit(False))


def text_present(name: str) -> Rule:
    return lambda schema: F.coalesce(_typed(schema, name, StringType), F.lit("")) != ""


def text_missing(name: str) -> Rule:
    return lambda schema: F.coalesce(_typed(schema, name, StringType), F.lit("")) == ""


def text_to_number(name: str) -> Rule:
    """Number held as text; empty or bad text gives NULL."""
    return lambda schema: _typed(schema, name, StringType).try_cast("decimal(38,0)").cast("bigint")


def any_of(*rules: Rule) -> Rule:
    def build(schema: StructType) -> Column:
        flag = F.lit(False)
        for rule in rules:
            flag = flag | rule(schema)
        return flag
    return build


def sql_rule(expression: str) -> Rule:
    """A flag written as a SQL expression; the type check is the analyser's."""
    return lambda schema: F.expr(expression)
