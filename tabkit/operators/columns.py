"""Projections, predicates and scalar column operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.functions.scalar import clip_col, label_from_name, name_from_value, run_id_col


def _missing(df: DataFrame, cols: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c not in have]


def select_features(df: DataFrame, cols: list[str]) -> DataFrame:
    """Project an ordered feature list; an unknown name is an error."""
    miss = _missing(df, cols)
    if miss:
        raise KeyError(f"columns not found: {miss}")
    return df.select(*[F.col(f"`{c}`") for c in cols])


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop columns; unlike ``DataFrame.drop`` an unknown name is an error."""
    miss = _missing(df, cols)
    if miss:
        raise KeyError(f"columns not found: {miss}")
    return df.drop(*cols)


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def columns_by_type(df: DataFrame, kinds: Iterable[str]) -> list[str]:
    """Names of the columns whose type class is in ``kinds``
    (``bool``, ``string``, ``numeric``, ``array``, ``timestamp``)."""
    kinds = set(kinds)
    out = []
    for f in df.schema.fields:
        t = f.dataType
        kind = ("bool" if isinstance(t, T.BooleanType) else
                "string" if isinstance(t, T.StringType) else
                "numeric" if isinstance(t, _NUMERIC) else
                "array" if isinstance(t, T.ArrayType) else
                "timestamp" if isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)) else
                "other")
        if kind in kinds:
            out.append(f.name)
    return out


def select_by_type(df: DataFrame, kinds: Iterable[str]) -> DataFrame:
    """P3 as a projection."""
    return df.select(*columns_by_type(df, kinds))


def columns_by_prefix(df: DataFrame, prefix: str) -> list[str]:
    """Names starting with ``prefix``, in schema order."""
    return [c for c in df.columns if c.startswith(prefix)]


def binary_columns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """P5: which numeric columns hold only 0/1 and no null.

    One aggregate pass (``bool_and`` per column, partial on the map side)
    unpivoted to ``(column, is_binary)``.
    """
    cols = cols or columns_by_type(df, ["numeric", "bool"])
    aggs = [F.coalesce(F.bool_and(F.col(c).isNotNull() & F.col(c).cast("double").isin(0.0, 1.0)),
                       F.lit(False)).alias(c) for c in cols]
    wide = df.agg(*aggs)
    return wide.unpivot([], cols, "column", "is_binary")


def flag(df: DataFrame, name: str, predicate: Column) -> DataFrame:
    """Derived 0/1 label from a predicate (a null predicate gives 0)."""
    return df.withColumn(name, F.coalesce(predicate, F.lit(False)).cast("int"))


def cast_flags(df: DataFrame, cols: list[str], to: str = "int", strict: bool = True) -> DataFrame:
    """Cast bool/number columns to int or double in one projection.

    With ``strict`` a null in an int cast raises (via ``assert_true``) rather
    than silently producing a null; the check runs inside the same scan.
    """
    exprs = {}
    for c in cols:
        v = F.col(c).cast(to)
        if strict and to in ("int", "bigint"):
            v = F.when(F.assert_true(F.col(c).isNotNull(), f"null in column {c}").isNull(), v)
        exprs[c] = v
    return df.withColumns(exprs)


def flag_shares(df: DataFrame, cols: list[str]) -> DataFrame:
    """P7 report: count and share of ones per flag column, one aggregate."""
    n = F.count(F.lit(1))
    aggs = []
    for c in cols:
        aggs += [F.sum(F.col(c).cast("bigint")).alias(f"{c}__ones")]
    wide = df.agg(n.alias("__n"), *aggs)
    long = wide.unpivot(["__n"], [f"{c}__ones" for c in cols], "column", "ones")
    return long.select(F.regexp_replace("column", "__ones$", "").alias("column"),
                       F.col("ones"),
                       F.round(F.col("ones") / F.col("__n") * 100, 4).alias("pct"))


def clip(df: DataFrame, bounds: Mapping[str, tuple]) -> DataFrame:
    """Clip columns into [lo, hi]; null stays null."""
    return df.withColumns({c: clip_col(c, lo, hi) for c, (lo, hi) in bounds.items()})


def log1p_columns(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """log(1 + x), in place or into ``col + suffix``."""
    return df.withColumns({c + suffix: F.log1p(F.col(c)) for c in cols})


def to_column_name(col) -> Column:
    """P10: value -> column-name fragment."""
    return name_from_value(col)


def to_label(col, prefix: str = "") -> Column:
    """P10: column name -> title-case label."""
    return label_from_name(col, prefix)


def threshold(df: DataFrame, score_col: str, t: float = 0.5, as_type: str = "int",
              out_col: str | None = None) -> DataFrame:
    """Score -> class with strict ``score > t``."""
    return df.withColumn(out_col or score_col, (F.col(score_col) > F.lit(t)).cast(as_type))


def drop_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep rows where all ``cols`` are not null."""
    return df.dropna(subset=cols)


def preview(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """First ``n`` rows in an explicit order (a TakeOrdered, no full sort)."""
    return df.orderBy(*order_by).limit(n)


def run_id(df: DataFrame, ts_col: str, out_col: str = "run_id") -> DataFrame:
    """Run tag ``yyyyMMdd-HHmmss`` from a timestamp column."""
    return df.withColumn(out_col, run_id_col(ts_col))
