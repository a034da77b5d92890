"""Scaling operators (N1-N3).  Fit = one aggregate row (partial per task,
one tiny merge); apply = one projection with the statistics as literals."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the variance floor of the normalisation layer the reference uses.
NORMALIZER_EPSILON = 1e-7


@dataclass(frozen=True)
class MinMaxParams:
    mins: dict
    maxs: dict


def fit_minmax(df: DataFrame, cols: list[str]) -> MinMaxParams:
    """N1 fit: per-column min and max."""
    row = df.agg(*[F.min(c).cast("double").alias(f"mn_{i}") for i, c in enumerate(cols)],
                 *[F.max(c).cast("double").alias(f"mx_{i}") for i, c in enumerate(cols)]).first()
    return MinMaxParams({c: row[f"mn_{i}"] for i, c in enumerate(cols)},
                        {c: row[f"mx_{i}"] for i, c in enumerate(cols)})


def apply_minmax(df: DataFrame, params: MinMaxParams) -> DataFrame:
    """N1 apply: (x - min) / (max - min); a constant column maps to 0."""
    exprs = {}
    for c, mn in params.mins.items():
        mx = params.maxs[c]
        if mn is None:
            exprs[c] = F.col(c).cast("double")
            continue
        rng = mx - mn
        exprs[c] = (F.col(c).cast("double") - F.lit(mn)) / F.lit(rng if rng != 0 else 1.0)
    return df.withColumns(exprs)


@dataclass(frozen=True)
class StandardParams:
    means: dict
    scales: dict


def fit_moments(df: DataFrame, cols: list[str]) -> tuple[dict, dict]:
    row = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    return ({c: row[f"m_{i}"] for i, c in enumerate(cols)},
            {c: row[f"s_{i}"] for i, c in enumerate(cols)})


def fit_standard(df: DataFrame, cols: list[str]) -> StandardParams:
    """N2 fit: mean and **population** standard deviation (fit on train)."""
    means, stds = fit_moments(df, cols)
    return StandardParams(means, {c: (s if s else 1.0) for c, s in stds.items()})


def apply_standard(df: DataFrame, params: StandardParams) -> DataFrame:
    """N2 apply: (x - mean) / std; a constant column maps to 0."""
    return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(params.scales[c])
                           for c, m in params.means.items() if m is not None})


def fit_normalizer(df: DataFrame, cols: list[str], epsilon: float = NORMALIZER_EPSILON) -> StandardParams:
    """N3 fit: mean and max(sqrt(population variance), epsilon)."""
    means, stds = fit_moments(df, cols)
    return StandardParams(means, {c: max(s or 0.0, epsilon) for c, s in stds.items()})


def apply_normalizer(df: DataFrame, params: StandardParams) -> DataFrame:
    """N3 apply: (x - mean) / max(std, epsilon)."""
    return apply_standard(df, params)
