"""Encoding and nested-data operators.

Fitting a one-hot / ordinal / multi-hot encoder decides the output schema,
so the fitted level list has to reach the driver (as in ``StringIndexer``).
Levels are gathered with a distributed ``distinct`` and capped by
``max_levels``: above the cap the fit raises instead of building an
unbounded projection.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabkit.functions.frames import materialize
from tabkit.functions.scalar import name_from_value, name_from_value_py, strip_ws

MAX_LEVELS = 1000


def _levels(df: DataFrame, col, max_levels: int) -> list:
    """Sorted distinct non-null values of a column (or of all elements of an
    array column), at most ``max_levels``."""
    c = F.col(col) if isinstance(col, str) else col
    vals = df.select(c.alias("v")).where(F.col("v").isNotNull()).distinct()
    rows = vals.orderBy("v").limit(max_levels + 1).collect()
    if len(rows) > max_levels:
        raise ValueError(f"more than {max_levels} levels in {col}; raise max_levels")
    return [r["v"] for r in rows]


def _ordinal_expr(col: str, levels: list) -> Column:
    pos = F.array_position(F.array(*[F.lit(v) for v in levels]), F.col(col))
    return F.when(pos > 0, (pos - 1).cast("int"))


def encode_ordered(df: DataFrame, mapping: dict[str, list]) -> DataFrame:
    """code = position in an explicit ordered level list (0-based);
    an unknown label or a null gives null."""
    return df.withColumns({c: _ordinal_expr(c, levels) for c, levels in mapping.items()})


@dataclass(frozen=True)
class OrdinalParams:
    levels: dict  # column -> sorted list of levels


def fit_ordinal(df: DataFrame, cols: list[str], max_levels: int = MAX_LEVELS) -> OrdinalParams:
    """Fit sorted distinct values per column (codes 0..k-1).  More than
    ``max_levels`` values in a column are an error."""
    return OrdinalParams({c: _levels(df, c, max_levels) for c in cols})


def apply_ordinal(df: DataFrame, params: OrdinalParams, suffix: str = "") -> DataFrame:
    """Replace (or add ``c + suffix``) the ordinal code; unseen/null -> null.

    Codes come from a broadcast lookup of the fitted levels (bounded by
    ``max_levels``), whatever their number; columns keep their order, added
    ones follow in the order of ``params``."""
    spark, out, codes = df.sparkSession, df, {}
    for i, (c, lv) in enumerate(params.levels.items()):
        lookup = spark.createDataFrame([(v, n) for n, v in enumerate(lv)],
                                       f"`__lvl{i}` {df.schema[c].dataType.simpleString()}, `__code{i}` int")
        out = out.join(F.broadcast(lookup), F.col(f"`{c}`") == F.col(f"__lvl{i}"), "left")
        codes[c + suffix] = F.col(f"__code{i}")
    kept = [codes.pop(c).alias(c) if c in codes else F.col(f"`{c}`") for c in df.columns]
    return out.select(*kept, *[code.alias(name) for name, code in codes.items()])


#: An ordinal table of at most so many levels is broadcast; a larger one is joined by key.
BROADCAST_LEVELS = 500_000


def fit_ordinal_table(df: DataFrame, col: str) -> DataFrame:
    """E2 for any number of levels: ``level``, ``code`` (0, 1, 2... in sorted
    order) of the distinct non-null values, as a table.

    Distinct values (reduced inside each task first) are laid out in sorted
    ranges; a value's code is its place in its range plus the sizes of the
    ranges before.  Only these sizes reach the driver, one per range."""
    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    levels = df.select(F.col(f"`{col}`").alias("level")).where("level is not null").distinct()
    laid = materialize(levels.repartitionByRange(n, "level").sortWithinPartitions("level"))
    # an id made on the laid rows is the range's number above 33 bits, the place inside below
    placed = laid.select("level", F.monotonically_increasing_id().alias("_place"), F.spark_partition_id().alias("_part"))
    start, before = 0, []
    for r in sorted(placed.groupBy("_part").agg(F.count("*").alias("n")).collect(), key=lambda r: r["_part"]):
        before.append((r["_part"], start))
        start += r["n"]
    starts = spark.createDataFrame(before, "_part int, _before bigint")
    return placed.join(F.broadcast(starts), "_part").select(
        "level", (F.col("_before") + F.col("_place").bitwiseAND((1 << 33) - 1)).alias("code"))


def apply_ordinal_table(df: DataFrame, col: str, table: DataFrame, out_col: str,
                        broadcast_levels: int = BROADCAST_LEVELS) -> DataFrame:
    """``df`` with the codes of ``col`` by a table of
    :func:`fit_ordinal_table`; unseen and null give null.  The table is
    broadcast if it has ``broadcast_levels`` rows at most (counted), else joined
    by key, where Spark divides a hot one."""
    small = table.count() <= broadcast_levels
    codes = table.select(F.col("level").alias("__level"), F.col("code").alias("__code"))
    joined = df.join(F.broadcast(codes) if small else codes, F.col(f"`{col}`") == F.col("__level"), "left")
    return joined.withColumn(out_col, F.col("__code")).drop("__level", "__code")


@dataclass(frozen=True)
class OneHotParams:
    categories: dict  # column -> list of levels
    names: dict       # column -> list of output names (aligned to levels)


def fit_one_hot(df: DataFrame, cols: list[str], max_levels: int = MAX_LEVELS,
                normalise: bool = False, prefixes: dict | None = None) -> OneHotParams:
    """E3/E9 fit: sorted levels per column and their output column names
    ``prefix_level`` (``normalise`` lower-cases and replaces blanks/slashes).
    More than ``max_levels`` values in a column are an error."""
    cats, names = {}, {}
    for c in cols:
        lv = _levels(df, c, max_levels)
        p = (prefixes or {}).get(c, c)
        cats[c] = lv
        names[c] = [f"{p}_{name_from_value_py(str(v)) if normalise else v}" for v in lv]
    return OneHotParams(cats, names)


def apply_one_hot(df: DataFrame, params: OneHotParams, dtype: str = "int",
                  drop_source: bool = True) -> DataFrame:
    """E3/E9 apply: one 0/1 column per fitted level; a null or a level not
    seen at fit time gives all zeros.  Levels of one column that normalise to
    the same name are OR-ed; a name that two columns give, or that the input
    has already, is an error.  One projection, no shuffle."""
    exprs: dict[str, Column] = {}
    taken = {c for c in df.columns if not (drop_source and c in params.categories)}
    for c, levels in params.categories.items():
        by_name: dict[str, list] = {}
        for v, n in zip(levels, params.names[c]):
            by_name.setdefault(n, []).append(v)
        clash = sorted(taken & set(by_name))
        if clash:
            raise ValueError(f"one-hot columns of {c} clash with existing ones: {clash}")
        taken |= set(by_name)
        for n, vals in by_name.items():
            hit = F.col(c).isin(*vals) if len(vals) > 1 else (F.col(c) == F.lit(vals[0]))
            exprs[n] = F.coalesce(hit, F.lit(False)).cast(dtype)
    keep = [F.col(f"`{c}`") for c in df.columns
            if not (drop_source and c in params.categories) and c not in exprs]
    return df.select(*keep, *[e.alias(n) for n, e in exprs.items()])


def one_hot(df: DataFrame, cols: list[str], categories: dict | None = None,
            dtype: str = "int", max_levels: int = MAX_LEVELS) -> DataFrame:
    """One-hot of the given string columns, all levels kept."""
    params = (OneHotParams(categories, {c: [f"{c}_{v}" for v in lv] for c, lv in categories.items()})
              if categories is not None else fit_one_hot(df, cols, max_levels))
    return apply_one_hot(df, params, dtype)


def one_hot_named(df: DataFrame, col: str, prefix: str | None = None,
                  max_levels: int = MAX_LEVELS) -> tuple[DataFrame, DataFrame]:
    """One-hot with normalised names, null skipped, source dropped; also
    returns the level report ``(column, label, count, pct)`` where pct is the
    share of all rows (nulls stay in the denominator)."""
    from tabkit.operators.profile import flag_rates_long
    params = fit_one_hot(df, [col], max_levels, normalise=True, prefixes={col: prefix or col})
    encoded = apply_one_hot(df, params)
    new_cols = list(dict.fromkeys(params.names[col]))
    report = flag_rates_long(encoded, new_cols, label_prefix=f"{prefix or col}_")
    return encoded, report


@dataclass(frozen=True)
class MultiHotParams:
    prefix: str
    names: dict  # output name -> list of raw elements mapping to it


def fit_multi_hot(df: DataFrame, array_col: str, prefix: str | None = None,
                  max_levels: int = MAX_LEVELS) -> MultiHotParams:
    """E5 fit: distinct elements over all lists (explode + distinct)."""
    p = prefix or array_col
    elems = _levels(df, F.explode(F.col(array_col)), max_levels)
    names: dict[str, list] = {}
    for e in elems:
        names.setdefault(f"{p}_{name_from_value_py(str(e))}", []).append(e)
    return MultiHotParams(p, dict(sorted(names.items())))


def _member_of(values: tuple):
    """One-argument predicate for higher-order functions (Spark inspects the
    arity, so extra default arguments are not allowed)."""
    def pred(x: Column) -> Column:
        return x.isin(*values)
    return pred


def apply_multi_hot(df: DataFrame, array_col: str, params: MultiHotParams,
                    drop_source: bool = False) -> DataFrame:
    """E5 apply: one 0/1 column per element name (``array_contains``)."""
    exprs = {}
    for n, vals in params.names.items():
        if len(vals) == 1:
            hit = F.array_contains(F.col(array_col), F.lit(vals[0]))
        else:
            hit = F.exists(F.col(array_col), _member_of(tuple(vals)))
        exprs[n] = F.coalesce(hit, F.lit(False)).cast("int")
    out = df.withColumns(exprs)
    return out.drop(array_col) if drop_source else out


def multi_hot(df: DataFrame, array_col: str, prefix: str | None = None,
              max_levels: int = MAX_LEVELS) -> DataFrame:
    """E5: fit + apply."""
    return apply_multi_hot(df, array_col, fit_multi_hot(df, array_col, prefix, max_levels))


def parse_list(df: DataFrame, col: str, out_col: str | None = None) -> DataFrame:
    """Parse a list or tuple literal such as ``['full sun', None]``;
    malformed text or null gives an empty list.  ``None`` is a null element."""
    text = F.trim(F.col(col))
    # outside quotes: an even number of each quote follows
    outside = r"(?=(?:[^'\"]|'[^']*'|\"[^\"]*\")*$)"
    text = F.regexp_replace(text, rf"\bNone\b{outside}", "null")
    text = F.regexp_replace(text, r"^\((.*)\)$", "[$1]")
    text = F.regexp_replace(text, r",\s*\]$", "]")
    parsed = F.from_json(text, "array<string>", {"allowSingleQuotes": "true", "mode": "PERMISSIVE"})
    return df.withColumn(out_col or col, F.coalesce(parsed, F.array().cast("array<string>")))


def flatten_lists(df: DataFrame, cols: list[str] | None = None, sep: str = ", ") -> DataFrame:
    """List columns -> ``sep``-joined text; an empty or null list -> null."""
    from tabkit.operators.columns import columns_by_type
    cols = cols if cols is not None else columns_by_type(df, ["array"])
    return df.withColumns({c: F.when(F.size(c) > 0, F.array_join(F.col(c), sep, "None"))
                           for c in cols})


def explode_tokens(df: DataFrame, col: str, sep: str = ",", out_col: str = "token") -> DataFrame:
    """Split text on ``sep``, strip whitespace around each piece, one row per piece (nulls
    dropped first)."""
    return (df.where(F.col(col).isNotNull())
            .withColumn(out_col, F.explode(F.transform(F.split(F.col(col), re.escape(sep)), strip_ws))))


def align_columns(df: DataFrame, train_cols: list[str], fill=0) -> DataFrame:
    """Same columns, same order as training; missing -> ``fill``, extra
    columns dropped."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") if c in have else F.lit(fill).alias(c) for c in train_cols])


def name_column(col) -> Column:
    """Normalised name of a category value (see P10)."""
    return name_from_value(col)
