"""Functions over nested values: every string leaf, whatever the schema, found when the plan is made."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from .text import WHITE_SPACE

_EDGE = f"^[{WHITE_SPACE}\\x{{1C}}-\\x{{1F}}]+|[{WHITE_SPACE}\\x{{1C}}-\\x{{1F}}]+$"


def with_leaves(value: Column, kind: Ty.DataType, change: Callable[[Column], Column]) -> Column:
    """The value with each of its strings changed; map keys and other values stay."""
    if isinstance(kind, Ty.StringType):
        return change(value)
    if isinstance(kind, Ty.ArrayType):
        return F.transform(value, lambda x: with_leaves(x, kind.elementType, change))
    if isinstance(kind, Ty.MapType):
        return F.transform_values(value, lambda _, x: with_leaves(x, kind.valueType, change))
    if isinstance(kind, Ty.StructType):
        return F.when(value.isNotNull(), F.struct(*(with_leaves(value[f.name], f.dataType, change).alias(f.name) for f in kind)))
    return value


def cleaned(df: DataFrame) -> DataFrame:
    """df with CRLF and CR as LF and without outer white space in every string of every column."""
    change = lambda s: F.regexp_replace(F.regexp_replace(s, "\r\n?", "\n"), _EDGE, "")
    return df.select(*(with_leaves(F.col(f"`{f.name}`"), f.dataType, change).alias(f.name) for f in df.schema))


def string_leaves(value: Column, kind: Ty.DataType) -> Column:
    """All strings of a value in order, as an array; nulls are left out, map keys are none."""
    none = F.array().cast("array<string>")
    if isinstance(kind, Ty.StringType):
        return F.array_compact(F.array(value))
    if isinstance(kind, Ty.ArrayType):
        return F.coalesce(F.flatten(F.transform(value, lambda x: string_leaves(x, kind.elementType))), none)
    if isinstance(kind, Ty.MapType):
        return string_leaves(F.map_values(value), Ty.ArrayType(kind.valueType))
    if isinstance(kind, Ty.StructType) and len(kind):
        return F.concat(*(string_leaves(value[f.name], f.dataType) for f in kind))
    return none
