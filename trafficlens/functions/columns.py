"""Column and frame utilities: casts, renames, ordering, null filling."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round2(c, digits: int = 2) -> Column:
    """Half-up rounding to ``digits`` decimals."""
    return F.round(as_col(c), digits)


def normalize_columns(df: DataFrame, prefix: str = "ga:", lower: bool = False) -> DataFrame:
    """Strip ``prefix`` from every column name, optionally lower-case."""
    names = [n.replace(prefix, "") for n in df.columns]
    if lower:
        names = [n.lower() for n in names]
    return df.toDF(*names)


def cast_metrics(df: DataFrame, names: Iterable[str], type_: str = "bigint") -> DataFrame:
    """Cast the listed columns (exact, case-sensitive name match) to an
    integer type; other columns are untouched."""
    wanted = set(names)
    return df.select(*[F.col(f"`{n}`").cast(type_).alias(n) if n in wanted else F.col(f"`{n}`") for n in df.columns])


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast by name, e.g. ``{"COST": "double", "CITY": "string"}``.
    NULL stays NULL."""
    lowered = {k.lower(): v for k, v in types.items()}
    return df.select(*[
        F.col(f"`{n}`").cast(lowered[n.lower()]).alias(n) if n.lower() in lowered else F.col(f"`{n}`")
        for n in df.columns
    ])


def move_column(df: DataFrame, name: str, pos: int) -> DataFrame:
    """P20: move ``name`` to position ``pos`` (0-based), keeping the others' order."""
    others = [c for c in df.columns if c != name]
    others.insert(pos, name)
    return df.select(*[F.col(f"`{c}`") for c in others])


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """P21."""
    return df.drop(*names)


def fill_null_zero(df: DataFrame) -> DataFrame:
    """Nulls -> 0 in numeric columns and '0' in text columns (the pandas
    fill puts the number 0 into text columns; its text form is '0')."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    out = df.fillna(0, subset=numeric) if numeric else df
    return out.fillna("0", subset=text) if text else out
