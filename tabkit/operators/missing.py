"""Missing-data operators (M1-M6)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.functions.frames import with_scalars
from tabkit.operators.columns import columns_by_type


def no_nan(df: DataFrame, col: str) -> Column:
    """The column with NaN as null: one notion of missing for all operators
    of this module."""
    c = F.col(f"`{col}`")
    return F.when(~F.isnan(c), c) if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)) else c


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NaN becomes null in the given (default: all) float columns, as on
    ingest."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: no_nan(df, c) for c in floats if cols is None or c in cols})


def fill_constant(df: DataFrame, value, cols: list[str] | None = None,
                  include_strings: bool = False) -> DataFrame:
    """M1: replace nulls (and NaN) with a constant.

    Typed: a numeric ``value`` fills numeric columns (cast to each column's
    type); strings are filled only when ``include_strings`` is set (with the
    value's text) or when ``value`` itself is a string.
    """
    kinds = ["numeric", "bool"]
    if include_strings or isinstance(value, str):
        kinds.append("string")
    targets = columns_by_type(df, kinds)
    if cols is not None:
        targets = [c for c in targets if c in set(cols)]
    types = {f.name: f.dataType for f in df.schema.fields}
    exprs = {}
    for c in targets:
        t = types[c]
        if isinstance(t, T.StringType):
            lit = F.lit(str(value))
        elif isinstance(value, str):
            continue
        else:
            lit = F.lit(value).cast(t)
        exprs[c] = F.coalesce(no_nan(df, c), lit)
    return df.withColumns(exprs) if exprs else df


def fill_mean(df: DataFrame, cols: list[str], only_if_nulls: bool = False) -> DataFrame:
    """M2: fill each column (nulls and NaN) with its own mean.

    The means (and, with ``only_if_nulls``, the null counts) are one
    aggregate row -- partial per task, one tiny merge -- attached as
    literals.  With ``only_if_nulls`` a column without nulls is left exactly
    as it is (type included); otherwise every listed column becomes double.
    """
    aggs = [F.avg(no_nan(df, c)).alias(f"__mean_{c}") for c in cols]
    if only_if_nulls:
        aggs += [F.count_if(no_nan(df, c).isNull()).alias(f"__nulls_{c}") for c in cols]
        row = df.agg(*aggs).first()
        todo = {c for c in cols if row[f"__nulls_{c}"]}
        return df.withColumns({c: F.coalesce(no_nan(df, c).cast("double"), F.lit(row[f"__mean_{c}"]).cast("double"))
                               for c in cols if c in todo})
    out = df.transform(with_scalars(df.agg(*aggs)))
    return out.select(*[F.coalesce(no_nan(df, c).cast("double"), F.col(f"__mean_{c}")).alias(c)
                        if c in cols else F.col(c) for c in df.columns])


@dataclass(frozen=True)
class ImputerParams:
    """Fitted means (statistics only, collected as one row)."""
    means: dict


def fit_imputer(df: DataFrame, cols: list[str]) -> ImputerParams:
    """M3: fit per-column means on (training) data; an all-null column is an
    error naming the column."""
    row = df.agg(*[F.avg(no_nan(df, c)).alias(c) for c in cols]).first()
    means = {c: row[c] for c in cols}
    empty = [c for c, v in means.items() if v is None]
    if empty:
        raise ValueError(f"cannot impute all-null columns: {empty}")
    return ImputerParams(means)


def apply_imputer(df: DataFrame, params: ImputerParams) -> DataFrame:
    """M3: fill nulls and NaN with the fitted means (a single projection)."""
    return df.withColumns({c: F.coalesce(no_nan(df, c).cast("double"), F.lit(float(m)))
                           for c, m in params.means.items()})


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """M4: missing values (null or NaN) per column, one aggregate unpivoted to
    (column, nulls)."""
    cols = cols or df.columns
    wide = df.agg(*[F.count_if(no_nan(df, c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "nulls")


def complete_predictions(ids: DataFrame, preds: DataFrame, id_col: str,
                         pred_col: str) -> DataFrame:
    """M5: every id gets a prediction; ids without one receive the mean
    prediction.  Left join on the key plus a one-row broadcast of the mean."""
    mean = preds.agg(F.avg(pred_col).alias("__mean"))
    joined = ids.select(id_col).join(preds.select(id_col, pred_col), id_col, "left")
    return (joined.transform(with_scalars(mean))
            .select(id_col, F.coalesce(F.col(pred_col).cast("double"), F.col("__mean")).alias(pred_col)))


def table_info(df: DataFrame) -> DataFrame:
    """M6: (position, column, type, non_null, rows) in one aggregate pass;
    position is 1-based."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count(F.col(f"`{c}`")).alias(c) for c in cols])
    long = wide.unpivot(["__rows"], cols, "column", "non_null")
    types = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString(), i + 1) for i, f in enumerate(df.schema.fields)],
        "column string, type string, position int")
    return (long.join(F.broadcast(types), "column")
            .select("position", "column", "type", "non_null", F.col("__rows").alias("rows")))
