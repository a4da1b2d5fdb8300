"""Comparison tables: one row an attribute, one column an entity, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Decimal digits that hold every value of a whole-number type.
DIGITS = {"byte": 3, "short": 5, "integer": 10, "long": 19}


def named(name: str) -> Column:
    """A column by its whole name, dots and back quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def common_type(kinds: Sequence[T.DataType]) -> T.DataType:
    """The narrowest type that holds values of all ``kinds`` as they are.

    Whole numbers give a long, decimals among them a decimal wide enough for all,
    and a float or double a double; what no such type holds, or isn't a number,
    becomes a string.
    """
    names = {k.typeName() for k in kinds}
    if len(set(kinds)) == 1 and names <= {"decimal", "date", "timestamp", "timestamp_ntz", "boolean"}:
        return kinds[0]
    if names <= {*DIGITS}:
        return T.LongType()
    if names <= {*DIGITS, "decimal"}:
        scale = max(k.scale for k in kinds if isinstance(k, T.DecimalType))
        whole = max(k.precision - k.scale if isinstance(k, T.DecimalType) else DIGITS[k.typeName()] for k in kinds)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    if names <= {*DIGITS, "decimal", "float", "double"}:
        return T.DoubleType()
    return T.StringType()


def melt(df: DataFrame, entity: str, attributes: Sequence[str]) -> DataFrame:
    """Long form: ``entity``, ``attribute``, ``value``; null values are left out.

    Values have the common type of all ``attributes``, so that longs and decimals
    keep every digit; only where a double takes part all become doubles.
    """
    kind = common_type([df.schema[a].dataType for a in attributes])
    wide = df.select(named(entity), *[named(a).cast(kind).alias(a) for a in attributes])
    return wide.unpivot(named(entity), [named(a) for a in attributes], "attribute", "value").where(F.col("value").isNotNull())


def compare(long: DataFrame, entity: str, entities: Sequence[str], attribute: str = "attribute", value: str = "value") -> DataFrame:
    """Side by side: one row an attribute, a column for each of ``entities`` with its greatest value.

    The entities are named so that the columns don't depend on the data and no
    job has to find them.  The aggregation is partial before its one shuffle.
    """
    own = long.where(named(entity).isin(list(entities)))
    return own.groupBy(named(attribute)).agg(*[F.max(F.when(named(entity) == e, named(value))).alias(e) for e in entities])


def spread(table: DataFrame, entity: str = "entity", attribute: str = "attribute", value: str = "value") -> DataFrame:
    """The inverse of ``compare``: long form again, without empty cells."""
    columns = [named(c) for c in table.columns if c != attribute]
    out = table.unpivot(named(attribute), columns, entity, value).where(named(value).isNotNull())
    return out.select(named(entity), named(attribute), named(value))
