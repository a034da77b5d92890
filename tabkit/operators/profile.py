"""Aggregations and profiling.

Shape rules: per-column statistics are fused into one aggregate over one
scan and unpivoted to long form; quantiles are exact but distributed (counts
per bucket, then only the buckets that hold a wanted rank) or sketch-based
(``percentile_approx``) -- never a single-task merge of all values.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabkit.functions.frames import fetch_row, with_scalars
from tabkit.functions.prefix import add_buckets, default_buckets
from tabkit.functions.scalar import label_from_name
from tabkit.functions.stats import null_safe_corr, sample_skewness
from tabkit.operators.columns import columns_by_type

# Box-plot whisker reach and the describe() percentiles.
WHISKER = 1.5
DESCRIBE_PROBS = (0.25, 0.5, 0.75)
#: Buckets per column of an exact quantile, at least.
MIN_BUCKETS = 64


def overview(df: DataFrame, flags: list[str]) -> DataFrame:
    """A1: (item, value): total rows and the sum of each flag column."""
    wide = df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.sum(F.col(c).cast("bigint")).alias(c) for c in flags])
    return wide.unpivot([], ["rows", *flags], "item", "value")


def value_counts(df: DataFrame, col: str, by: str = "count") -> DataFrame:
    """A2/A3: (value, count) without nulls; ordered by count desc (ties by
    value) or by value."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if by == "count":
        return counts.orderBy(F.desc("count"), F.asc(col))
    return counts.orderBy(col)


def value_share(df: DataFrame, col: str, decimals: int = 4) -> DataFrame:
    """A4: (value, count, pct) with pct of **all** rows, nulls included in the
    denominator.  The total is a one-row broadcast."""
    total = df.agg(F.count(F.lit(1)).alias("__n"))
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return (counts.transform(with_scalars(total))
            .select(col, "count", F.round(F.col("count") * 100.0 / F.col("__n"), decimals).alias("pct"))
            .orderBy(F.desc("count"), F.asc(col)))


def flag_rates(df: DataFrame, cols: list[str], rule: str = "mean", decimals: int = 4) -> DataFrame:
    """A5: share of ones per 0/1 column, long and descending.

    ``rule='mean'`` averages over non-null values; ``rule='rows'`` divides the
    sum by all rows."""
    if rule == "mean":
        aggs = [(F.avg(F.col(c).cast("double")) * 100).alias(c) for c in cols]
    else:
        aggs = [(F.sum(F.col(c).cast("double")) * 100 / F.count(F.lit(1))).alias(c) for c in cols]
    long = df.agg(*aggs).unpivot([], cols, "column", "pct")
    return long.select("column", F.round("pct", decimals).alias("pct")).orderBy(F.desc("pct"), "column")


def flag_rates_long(df: DataFrame, cols: list[str], label_prefix: str = "", decimals: int = 4) -> DataFrame:
    """Level report for one-hot columns: (column, label, count, pct of all rows)."""
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[F.sum(F.col(c).cast("bigint")).alias(c) for c in cols])
    long = wide.unpivot(["__n"], cols, "column", "count")
    return long.select("column", label_from_name(F.col("column"), label_prefix).alias("label"),
                       "count", F.round(F.col("count") * 100.0 / F.col("__n"), decimals).alias("pct"))


def _long_values(df: DataFrame, cols: list[str], extra: dict | None = None) -> DataFrame:
    """Wide numeric columns -> (column, v [, extra...]) rows, nulls dropped."""
    structs = []
    for i, c in enumerate(cols):
        fields = [F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("v")]
        for name, per_col in (extra or {}).items():
            fields.append(F.col(per_col[i]).alias(name))
        structs.append(F.struct(*fields))
    return (df.select(F.explode(F.array(*structs)).alias("__s")).select("__s.*")
            .where(F.col("v").isNotNull()))


def exact_quantiles(df: DataFrame, cols: list[str], probs=DESCRIBE_PROBS,
                    n_buckets: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles (``quantile_cont``) per column as
    (column, prob, value), computed without gathering any column in one task.

    Every column is cut into buckets at approximate quantiles.  One pass
    counts the values per (column, bucket); from these counts (columns x
    buckets rows, the only thing that comes back) follows which bucket holds
    each wanted rank.  Only the values of those buckets are then grouped and
    ranked inside their bucket, so a pass over continuous columns shuffles a
    few buckets of each, never all distinct values.
    """
    n_buckets = n_buckets or max(MIN_BUCKETS, default_buckets(df.sparkSession))
    wide, bcols = add_buckets(df.select(*[F.col(f"`{c}`") for c in cols]), cols, n_buckets)
    filled = [F.struct(F.lit(c).alias("column"), F.col(b).alias("b")) for c, b in zip(cols, bcols)]
    present = F.filter(F.array(*[F.when(F.col(f"`{c}`").isNotNull(), x) for c, x in zip(cols, filled)]), lambda x: x.isNotNull())
    counts: dict[str, list[tuple]] = {}
    for r in wide.select(F.explode(present).alias("x")).groupBy("x.column", "x.b").count().collect():
        counts.setdefault(r.column, []).append((r.b, r["count"]))
    targets, wanted = [], {}
    for c, found in counts.items():
        found.sort()
        ends = list(accumulate(n for _, n in found))
        for p in probs:
            pos = float(p) * (ends[-1] - 1)
            for side, rank in enumerate((math.floor(pos), math.ceil(pos))):
                k = bisect_right(ends, rank)
                targets.append((c, found[k][0], float(p), side, rank - (ends[k] - found[k][1]), pos - math.floor(pos)))
                wanted.setdefault(c, set()).add(found[k][0])
    schema = "t_col string, t_b double, prob double, side int, rank bigint, frac double"
    table = df.sparkSession.createDataFrame(targets, schema)
    picked = [F.when(F.col(b).isin(*sorted(wanted[c])), F.struct(F.lit(c).alias("column"), F.col(b).alias("b"),
                                                                   F.col(f"`{c}`").cast("double").alias("v")))
              for c, b in zip(cols, bcols) if c in wanted]
    if not picked:
        return table.select(F.col("t_col").alias("column"), "prob", F.lit(0.0).alias("value"))
    values = (wide.select(F.explode(F.filter(F.array(*picked), lambda x: x.isNotNull())).alias("x")).select("x.*")
              .where("v is not null").groupBy("column", "b", "v").agg(F.count(F.lit(1)).alias("cnt")))
    inside = Window.partitionBy("column", "b").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = values.withColumn("cum", F.sum("cnt").over(inside))
    # two rows per (column, prob): a bounded broadcast side
    hit = ranked.join(F.broadcast(table), (F.col("column") == F.col("t_col")) & (F.col("b") == F.col("t_b"))
                      & (F.col("cum") - F.col("cnt") <= F.col("rank")) & (F.col("rank") < F.col("cum")))
    ends = hit.groupBy("column", "prob", "frac").agg(F.max(F.when(F.col("side") == 0, F.col("v"))).alias("v_lo"),
                                                     F.max(F.when(F.col("side") == 1, F.col("v"))).alias("v_hi"))
    return ends.select("column", "prob", (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * F.col("frac")).alias("value"))


def approx_quantiles(df: DataFrame, cols: list[str], probs=DESCRIBE_PROBS,
                     accuracy: int = 10000) -> DataFrame:
    """Sketch quantiles (bounded state per column) as (column, prob, value)."""
    wide = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), list(probs), accuracy).alias(c)
                    for c in cols])
    long = wide.unpivot([], cols, "column", "qs")
    return long.select("column", F.posexplode("qs").alias("i", "value")).select(
        "column", F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("i") + 1).alias("prob"),
        "value")


def quantiles(df, cols, probs=DESCRIBE_PROBS, method: str = "exact") -> DataFrame:
    return exact_quantiles(df, cols, probs) if method == "exact" else approx_quantiles(df, cols, probs)


def describe(df: DataFrame, cols: list[str] | None = None, method: str = "exact") -> DataFrame:
    """Long (column, stat, value) with count, mean, std (sample), min,
    25%, 50%, 75%, max."""
    cols = cols or columns_by_type(df, ["numeric"])
    moments = df.agg(*[x for i, c in enumerate(cols) for x in (
        F.count(F.col(f"`{c}`")).cast("double").alias(f"count|{i}"),
        F.avg(F.col(f"`{c}`")).alias(f"mean|{i}"),
        F.stddev_samp(F.col(f"`{c}`")).alias(f"std|{i}"),
        F.min(F.col(f"`{c}`")).cast("double").alias(f"min|{i}"),
        F.max(F.col(f"`{c}`")).cast("double").alias(f"max|{i}"))])
    long = moments.unpivot([], moments.columns, "key", "value")
    idx = F.split("key", r"\|")
    names = F.array(*[F.lit(c) for c in cols])
    first = long.select(F.element_at(names, F.element_at(idx, 2).cast("int") + 1).alias("column"),
                        F.element_at(idx, 1).alias("stat"), "value")
    q = quantiles(df, cols, DESCRIBE_PROBS, method).select(
        "column", F.concat((F.col("prob") * 100).cast("int").cast("string"), F.lit("%")).alias("stat"),
        "value")
    return first.unionByName(q)


def skewness(df: DataFrame, cols: list[str]) -> DataFrame:
    """Bias-adjusted skewness per column, (column, skewness)."""
    wide = df.agg(*[sample_skewness(c).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "skewness")


def token_counts(df: DataFrame, col: str, sep: str = ",") -> DataFrame:
    """Frequency of trimmed tokens of a separated text column."""
    from tabkit.operators.encode import explode_tokens
    return explode_tokens(df, col, sep).groupBy("token").agg(F.count(F.lit(1)).alias("count"))


def combo_counts(df: DataFrame, array_col: str, n: int = 10, decimals: int = 4) -> DataFrame:
    """The ``n`` most frequent whole lists (order inside a list matters),
    with percent of all rows; ties broken by the lists themselves (element-wise
    order, a prefix first)."""
    total = df.agg(F.count(F.lit(1)).alias("__n"))
    counts = df.groupBy(F.col(array_col).alias("combo")).agg(F.count(F.lit(1)).alias("count"))
    top = counts.orderBy(F.desc("count"), F.asc("combo")).limit(n)
    return top.transform(with_scalars(total)).select(
        "combo", "count", F.round(F.col("count") * 100.0 / F.col("__n"), decimals).alias("pct"))


def distinct_values(df: DataFrame, col: str, explode: bool = False) -> DataFrame:
    """A10: sorted distinct non-null values of a column or of all list elements."""
    c = F.explode(F.col(col)) if explode else F.col(col)
    return df.select(c.alias("value")).where(F.col("value").isNotNull()).distinct().orderBy("value")


def correlation_matrix(df: DataFrame, cols: list[str], decimals: int | None = None) -> DataFrame:
    """Pearson r of every ordered pair (a, b) over pairwise-complete
    rows; a constant column gives null.  All pairs are ONE aggregate over
    one scan; its single row (one value per pair) is laid out as the
    (a, b, r) table, diagonal included."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = df.agg(*[null_safe_corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]).first() \
        if pairs else {}
    out = [(c, c, 1.0) for c in cols]
    for i, (a, b) in enumerate(pairs):
        out += [(a, b, row[f"r{i}"]), (b, a, row[f"r{i}"])]
    m = df.sparkSession.createDataFrame(out, "a string, b string, r double")
    return m.select("a", "b", F.round("r", decimals).alias("r")) if decimals is not None else m


def strong_correlations(df: DataFrame, cols: list[str], t: float = 0.3) -> DataFrame:
    """Upper-triangle pairs (in column order) with abs(r) > t."""
    order = {c: i for i, c in enumerate(cols)}
    m = correlation_matrix(df, cols)
    pos = F.create_map(*[x for c, i in order.items() for x in (F.lit(c), F.lit(i))])
    return m.where((pos[F.col("a")] < pos[F.col("b")]) & (F.abs("r") > t))


def target_correlation(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """R of every feature with the target, descending; a non-numeric
    feature scores 0."""
    numeric = set(columns_by_type(df, ["numeric", "bool"]))
    aggs = [(null_safe_corr(c, target) if c in numeric else F.lit(0.0)).alias(c) for c in cols]
    long = df.agg(*aggs).unpivot([], cols, "column", "r")
    return long.orderBy(F.desc_nulls_last("r"), "column")


def auto_bins(df: DataFrame, col: str, rule: str = "auto") -> int:
    """Number of equal-width bins for a histogram.  ``distinct``: one per
    distinct value.  ``auto``: the smaller of the widths that the
    Freedman-Diaconis rule (2 IQR / n^(1/3)) and the Sturges rule (range /
    (log2 n + 1)) give; the latter alone where the IQR is 0."""
    x = F.col(f"`{col}`").cast("double")
    if rule == "distinct":
        return max(1, df.agg(F.countDistinct(x)).first()[0])
    mn, mx, n = df.agg(F.min(x), F.max(x), F.count(x)).first()
    if not n or mx == mn:
        return 1
    q = {r.prob: r.value for r in exact_quantiles(df, [col], (0.25, 0.75)).collect()}
    widths = [(mx - mn) / (math.log2(n) + 1), 2 * (q[0.75] - q[0.25]) / n ** (1 / 3)]
    return max(1, math.ceil((mx - mn) / min(w for w in widths if w > 0)))


def histogram(df: DataFrame, col: str, bins: int | str = 10) -> DataFrame:
    """Equal-width histogram over [min, max]; the max falls in the last
    bin.  Every bin is listed (zero counts too): (bin, lo, hi, count).
    ``bins`` may name a rule of :func:`auto_bins`.

    min/max are fitted in one aggregate and inlined as literals; the counts
    are one grouped aggregate over at most ``bins`` keys (partial on the map
    side), joined to the ``bins``-row grid."""
    bins = auto_bins(df, col, bins) if isinstance(bins, str) else bins
    x = F.col(col).cast("double")
    st = fetch_row(df.agg(F.min(x).alias("mn"), F.max(x).alias("mx")))
    mn, mx = st["mn"], st["mx"]
    width = (mx - mn) / F.lit(bins)
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((x - mn) / width), F.lit(bins - 1))).cast("int")
    counts = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    grid = grid.select("bin", (mn + F.col("bin") * width).alias("lo"),
                       (mn + (F.col("bin") + 1) * width).alias("hi"))
    # counts has at most `bins` rows: a bounded broadcast side
    return (grid.join(F.broadcast(counts), "bin", "left")
            .select("bin", "lo", "hi", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def density(df: DataFrame, col: str, grid: int = 200, method: str = "binned",
            bins: int = 4096) -> DataFrame:
    """Gaussian kernel density on ``grid`` points spanning [min, max],
    Scott bandwidth h = std_sample * n^(-1/5): (i, x, density).

    ``binned`` (default) first reduces the column to ``bins`` equal-width bins,
    so the kernel work is independent of the row count; ``exact`` sums kernels
    over distinct values (weighted by their counts).  A column without two
    different values has no density: no rows.  Each point's ``grid``
    kernel values are generated and summed by grid index in the same stage
    (partial aggregation right after the generator), so only ``grid`` rows
    per task are shuffled.
    """
    x = F.col(col).cast("double")
    stats = df.agg(F.min(x).alias("mn"), F.max(x).alias("mx"), F.count(x).alias("n"),
                   F.stddev_samp(x).alias("sd"))
    stats = stats.withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    st = fetch_row(stats)
    mn, mx, n, h = st["mn"], st["mx"], st["n"], st["h"]
    x = F.when(h > 0, x)
    if method == "binned":
        width = (mx - mn) / F.lit(bins)
        bucket = F.when(width == 0, 0).otherwise(F.least(F.floor((x - mn) / width), F.lit(bins - 1)))
        pts = (df.where(x.isNotNull()).groupBy(bucket.alias("bk")).agg(F.count(F.lit(1)).alias("w"))
               .withColumn("v", mn + (F.col("bk") + 0.5) * width))
    else:
        pts = df.where(x.isNotNull()).groupBy(x.alias("v")).agg(F.count(F.lit(1)).alias("w"))
    step = (mx - mn) / F.lit(max(grid - 1, 1))
    contrib = pts.select(F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(grid - 1)),
        lambda i: F.col("w") * F.exp(-0.5 * F.pow((mn + i * step - F.col("v")) / h, 2))
    )).alias("i", "k"))
    sums = contrib.groupBy("i").agg(F.sum("k").alias("s"))
    norm = F.lit(1.0 / math.sqrt(2 * math.pi))
    return sums.select("i", (mn + F.col("i") * step).alias("x"),
                       (F.col("s") * norm / (n * h)).alias("density"))


def box_stats(df: DataFrame, cols: list[str], method: str = "exact") -> DataFrame:
    """Per column q1, median, q3, iqr, whiskers (the most extreme data
    points within 1.5 IQR of the box) and the outlier count."""
    q = quantiles(df, cols, (0.25, 0.5, 0.75), method)
    qw = q.groupBy("column").agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
                                   for p, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    qw = qw.withColumn("iqr", F.col("q3") - F.col("q1"))
    long = _long_values(df, cols)
    lo_f = F.col("q1") - WHISKER * F.col("iqr")
    hi_f = F.col("q3") + WHISKER * F.col("iqr")
    # qw has one row per column: a bounded broadcast side.
    agg = (long.join(F.broadcast(qw), "column")
           .groupBy("column").agg(F.min(F.when(F.col("v") >= lo_f, F.col("v"))).alias("whisker_lo"),
                                  F.max(F.when(F.col("v") <= hi_f, F.col("v"))).alias("whisker_hi"),
                                  F.count_if((F.col("v") < lo_f) | (F.col("v") > hi_f)).alias("n_outliers")))
    return qw.join(agg, "column")


def outliers(df: DataFrame, col: str, method: str = "exact") -> DataFrame:
    """Rows whose ``col`` lies outside the whiskers' fences."""
    b = box_stats(df, [col], method).select("q1", "q3", "iqr")
    x = F.col(col)
    return (df.transform(with_scalars(b))
            .where((x < F.col("q1") - WHISKER * F.col("iqr")) | (x > F.col("q3") + WHISKER * F.col("iqr")))
            .drop("q1", "q3", "iqr"))


def profile_report(df: DataFrame, ordinal: list[str] | None = None, flags: list[str] | None = None,
                   share_col: str | None = None, corr_cols: list[str] | None = None,
                   t: float = 0.3, method: str = "exact", decimals: int = 4) -> DataFrame:
    """One long table (section, item, metric, value) uniting the
    overview (A1), ordinal describe (A6), flag rates (A5), group shares (A4)
    and strong pairs (A12).

    Every global statistic of every section -- row count, flag sums and
    rates, ordinal count / mean / std / min / max and every correlation pair
    -- is ONE aggregate over one scan (one row comes back); only the
    quantiles and the group shares need passes of their own, and the
    shares reuse the fused row count as their denominator.
    """
    ordinal, flags, corr = list(ordinal or []), list(flags or []), list(corr_cols or [])
    pairs = [(a, b) for i, a in enumerate(corr) for b in corr[i + 1:]]

    def c(name):
        return F.col(f"`{name}`")

    aggs = [F.count(F.lit(1)).cast("double").alias("rows")]
    aggs += [F.sum(c(f).cast("bigint")).cast("double").alias(f"ov{i}") for i, f in enumerate(flags)]
    aggs += [F.round(F.avg(c(f).cast("double")) * 100, decimals).alias(f"fr{i}") for i, f in enumerate(flags)]
    for i, o in enumerate(ordinal):
        aggs += [F.count(c(o)).cast("double").alias(f"count{i}"), F.avg(c(o)).alias(f"mean{i}"),
                 F.stddev_samp(c(o)).alias(f"std{i}"), F.min(c(o)).cast("double").alias(f"min{i}"),
                 F.max(c(o)).cast("double").alias(f"max{i}")]
    aggs += [null_safe_corr(a, b).alias(f"r{k}") for k, (a, b) in enumerate(pairs)]
    # the fused aggregate and the quantile preparation (cut points, count
    # table, totals) are independent jobs: submitted together
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=2) as pool:
        fused = pool.submit(lambda: df.agg(*aggs).first())
        quant = pool.submit(quantiles, df, ordinal, DESCRIBE_PROBS, method) if ordinal else None
        row = fused.result()
        q = quant.result() if quant is not None else None

    out = [("overview", "rows", "value", row["rows"])]
    out += [("overview", f, "value", row[f"ov{i}"]) for i, f in enumerate(flags)]
    out += [("flags", f, "pct", row[f"fr{i}"]) for i, f in enumerate(flags)]
    for i, o in enumerate(ordinal):
        out += [("ordinal", o, stat, row[f"{stat}{i}"]) for stat in ("count", "mean", "std", "min", "max")]
    out += [("strong_pairs", f"{a} & {b}", "r", row[f"r{k}"]) for k, (a, b) in enumerate(pairs)
            if row[f"r{k}"] is not None and abs(row[f"r{k}"]) > t]
    schema = "section string, item string, metric string, value double"
    parts = [df.sparkSession.createDataFrame(out, schema)]
    if q is not None:
        parts.append(q.select(
            F.lit("ordinal").alias("section"), F.col("column").alias("item"),
            F.concat((F.col("prob") * 100).cast("int").cast("string"), F.lit("%")).alias("metric"), "value"))
    if share_col:
        counts = df.where(c(share_col).isNotNull()).groupBy(c(share_col).alias("__v")).agg(
            F.count(F.lit(1)).alias("__c"))
        parts.append(counts.select(
            F.lit("shares").alias("section"), F.col("__v").cast("string").alias("item"), F.lit("pct").alias("metric"),
            F.round(F.col("__c") * 100.0 / F.lit(row["rows"]), decimals).alias("value")))
    return reduce(DataFrame.unionByName, parts)


def prediction_summary(df: DataFrame, col: str) -> DataFrame:
    """(rows, nulls, mean) of a prediction column in one aggregate."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(col).isNull()).alias("nulls"),
                  F.avg(col).alias("mean"))


def sequence_counts(df: DataFrame, group_col: str, pos_col: str, value_col: str,
                    n: int = 10, decimals: int = 4) -> DataFrame:
    """A9 over long data: the ``n`` most frequent whole sequences, where a
    sequence is the ``value_col`` of one group read in ``pos_col`` order.

    No group is ever gathered to count: each group is reduced to a
    fingerprint (its length and the exact decimal sums of two independent
    64-bit hashes of position and value, order-aware through the former), the
    fingerprints are counted, and only the ``n`` winning sequences are
    materialised -- each from one representative group -- because they are
    the output.  Ties on count are broken by (length, fingerprint).

    Positions are part of the fingerprint, so sequences are compared by
    (position, value) pairs: groups must number their positions the same
    way (e.g. turns 0..n-1), as the driver tables do.
    """
    h = F.xxhash64(F.col(pos_col), F.col(value_col)).cast("decimal(20,0)")
    h2 = F.xxhash64(F.lit("second"), F.col(value_col), F.col(pos_col)).cast("decimal(20,0)")
    per = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("__len"), F.sum(h).alias("__fp"), F.sum(h2).alias("__fp2"))
    total = per.agg(F.count(F.lit(1)).alias("__n"))
    combos = per.groupBy("__len", "__fp", "__fp2").agg(F.count(F.lit(1)).alias("count"),
                                              F.min(group_col).alias("__rep"))
    top = combos.orderBy(F.desc("count"), "__len", "__fp").limit(n)
    reps = df.join(F.broadcast(top.select(F.col("__rep").alias(group_col))), group_col, "left_semi")
    seq = reps.groupBy(group_col).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos_col).alias("p"),
                                                         F.col(value_col).alias("v")))),
                    lambda s: s["v"]).alias("combo"))
    return (top.join(seq, top["__rep"] == seq[group_col]).transform(with_scalars(total))
            .select("combo", "count", F.round(F.col("count") * 100.0 / F.col("__n"), decimals).alias("pct")))
