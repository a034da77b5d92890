"""Published profile values, recomputed from the published level counts."""

import numpy as np
import pytest

from tabkit.operators import encode as E
from tabkit.operators import profile as A

# Published level counts, and what follows for the encoded columns.
COUNTS = {"watering": {"Minimum": 13, "Average": 121, "Frequent": 21},
          "maintenance": {"Low": 71, "Moderate": 72, "High": 11, None: 1},
          "cycle": {"Perennial": 79, "Herbaceous Perennial": 74, "Annual": 2},
          "care_level": {"Medium": 83, "Moderate": 21, "High": 7, "Low": 3, "Easy": 3, None: 38}}
ENCODED = {"watering": (1.05, 1.00, 0.47), "maintenance": (0.61, 1.00, 0.62)}
CYCLE_PCT = {"Perennial": 51.0, "Herbaceous Perennial": 47.7, "Annual": 1.3}
CARE_PCT = {"Medium": 53.5, "Moderate": 13.5, "High": 4.5, "Low": 1.9, "Easy": 1.9}


@pytest.fixture(scope="module")
def plants(spark):
    columns = [[v for v, n in counts.items() for _ in range(n)] for counts in COUNTS.values()]
    return spark.createDataFrame(list(zip(*columns)), ", ".join(f"{c} string" for c in COUNTS))


def test_encoded_mean_median_std(plants):
    assert plants.count() == 155
    encoded = E.encode_ordered(plants, {c: [v for v in COUNTS[c] if v] for c in ENCODED})
    got = {(r.section, r.item, r.metric): r.value for r in A.profile_report(encoded, ordinal=list(ENCODED)).collect()}
    for c, want in ENCODED.items():
        values = tuple(round(got["ordinal", c, m], 2) for m in ("mean", "50%", "std"))
        assert values == want, c


def test_level_shares(plants):
    cycle = E.one_hot(plants, ["cycle"])
    rates = {r.column: r.pct for r in A.flag_rates(cycle, [f"cycle_{v}" for v in COUNTS["cycle"]]).collect()}
    assert {c: round(p, 1) for c, p in rates.items()} == {f"cycle_{v}": p for v, p in CYCLE_PCT.items()}
    _, report = E.one_hot_named(plants, "care_level")
    assert {r.label: round(r.pct, 1) for r in report.collect()} == CARE_PCT  # nulls stay in the denominator


@pytest.mark.parametrize("seed", [1, 2])
def test_automatic_bins_follow_the_rules(spark, seed):
    x = np.random.default_rng(seed).gamma(2.0, size=500 * seed)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    edges = np.histogram_bin_edges(x, "auto")
    rows = A.histogram(df, "x", "auto").orderBy("bin").collect()
    assert [r["count"] for r in rows] == np.histogram(x, edges)[0].tolist()
    few = spark.createDataFrame([(float(v % 3),) for v in range(10)] + [(None,)], "x double")
    assert [r["count"] for r in A.histogram(few, "x", "distinct").orderBy("bin").collect()] == [4, 3, 3]
    assert A.auto_bins(spark.createDataFrame([(2.0,)], "x double"), "x") == 1
