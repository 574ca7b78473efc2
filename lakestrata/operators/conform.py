"""Bring drifting inputs to a declared shape in a single projection.

A ``Field`` says where a column comes from and what to do when the input lacks
it or holds nulls.  The choice between "cast what is there" and "use the
default" is made once, from the input's column names, so the executed plan is
one projection whatever the number of fields.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.columns import code


class MissingColumnError(ValueError):
    """An input lacks a column that has no default."""


@dataclass(frozen=True)
class Field:
    """One output column.

    dtype      target type; None leaves the input's type alone.
    normal     trim and upper-case the text.
    fallbacks  other columns to take the value from when ``name`` is absent.
               A fallback that is itself a field is used in its conformed form.
    absent     literal for when neither ``name`` nor a fallback is present.
    null_as    literal for null values, and for an absent column.
    required   absent column is an error instead of a typed null.
    """

    name: str
    dtype: str | None = "string"
    normal: bool = False
    fallbacks: Sequence[str] = ()
    absent: object = None
    null_as: object = None
    required: bool = False


def number(name: str, **kw) -> Field:
    return Field(name, "double", **kw)


def day(name: str, **kw) -> Field:
    return Field(name, "date", **kw)


def moment(name: str, **kw) -> Field:
    return Field(name, "timestamp", **kw)


def flag(name: str, default: str = "N") -> Field:
    return Field(name, normal=True, null_as=default)


def status(name: str, default: str | None = None) -> Field:
    return Field(name, normal=True, null_as=default)


def plain(name: str) -> Field:
    """Pass a column through untouched; its absence is an error."""
    return Field(name, dtype=None, required=True)


def conform(df: DataFrame, fields: Iterable[Field]) -> DataFrame:
    """Apply fields in place; other input columns pass through, new ones go last."""
    expressions = _resolve(df, fields)
    known = [expressions.get(name, F.col(f"`{name}`")).alias(name) for name in df.columns]
    added = [value.alias(name) for name, value in expressions.items() if name not in df.columns]
    return df.select(*known, *added)


def project(df: DataFrame, fields: Iterable[Field]) -> DataFrame:
    """Keep exactly the given fields, in their order."""
    return df.select(*[value.alias(name) for name, value in _resolve(df, fields).items()])


def _resolve(df: DataFrame, fields: Iterable[Field]) -> dict[str, Column]:
    by_name = {field.name: field for field in fields}
    present = set(df.columns)

    def typed(field: Field, value: Column) -> Column:
        if field.null_as is not None:
            value = F.coalesce(value, F.lit(field.null_as))
        if field.normal:
            return code(value)
        # A bad value must become null for the quality rules to see, not stop the job.
        return value if field.dtype is None else value.try_cast(field.dtype)

    def build(field: Field) -> Column:
        if field.name in present:
            return typed(field, F.col(f"`{field.name}`"))
        for other in field.fallbacks:
            if other in present:
                source = by_name.get(other)
                value = build(source) if source else F.col(f"`{other}`")
                return typed(field, value)
        if field.required:
            raise MissingColumnError(
                f"column '{field.name}' is missing from the input and has no default; "
                f"the input has: {', '.join(df.columns)}"
            )
        default = field.absent if field.absent is not None else field.null_as
        return F.lit(default).cast(field.dtype or "string")

    return {name: build(field) for name, field in by_name.items()}
