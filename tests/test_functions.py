"""Column expressions, prefix totals and percentiles against brute force."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewind.functions import expressions as x
from tradewind.functions.grouping import group_metrics
from tradewind.functions.ranking import SLICES, _sliced, coarse_bucket, grouped_percentile, prefix_totals


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_ratios_of_nothing_are_null(spark):
    row = one(
        spark,
        x.safe_div(F.lit(1.0), F.lit(0.0)),
        x.pct(F.lit(0), F.lit(0)),
        x.pct(F.lit(1), F.lit(3)),
        x.pct(F.lit(None).cast("int"), F.lit(3)),
    )
    assert tuple(row) == (None, None, 33.33, None)


def test_count_if_ignores_null_and_counts_zero_on_empty(frame):
    df = frame("v int", (1,), (None,), (0,))
    assert df.agg(x.count_if(F.col("v") == 1)).first()[0] == 1
    assert df.where("false").agg(x.count_if(F.col("v") == 1)).first()[0] == 0


def test_string_agg_distinct(frame):
    df = frame("g int, s string", (1, "b"), (1, "a"), (1, "b"), (1, None), (2, None))
    got = dict(df.groupBy("g").agg(x.string_agg_distinct("s")).collect())
    assert got == {1: "a, b", 2: None}


def test_haversine_survives_antipodes_and_nulls(spark):
    far = x.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(math.pi))
    missing = x.haversine_km(F.lit(None).cast("double"), F.lit(0.0), F.lit(0.0), F.lit(1.0))
    row = one(spark, far, missing)
    assert row[0] == pytest.approx(12742 * math.pi / 2)
    assert row[1] is None


def test_hash_bucket_equals_the_plain_definition(spark):
    got = spark.range(50).select("id", x.hash_bucket("id", 42)).collect()
    for key, bucket in got:
        digest = hashlib.md5(f"{key}|split|42".encode()).hexdigest()
        assert bucket == int(digest[:8], 16) % 10_000
    assert [b for k, b in got[:3]] == [9317, 3036, 29]


def test_weekday_name_outside_the_week_is_null(spark):
    assert one(spark, x.weekday_name(F.lit(8)), x.weekday_name(F.lit(7)))[:] == (None, "Воскресенье")


def _skewed(n=6000, seed=3):
    """A third of the rows in one group, heavy ties, NULL keys and NULL values."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        group = "hot" if rng.random() < 0.34 else rng.choice(["a", "b", None, "rare"])
        value = rng.choice([None, 7.0, 7.0, round(rng.lognormvariate(3, 2), 2), -rng.random()])
        rows.append((group, value))
    return rows + [("single", 5.0), ("empty", None)]


@pytest.mark.parametrize("q", [0.0, 0.05, 0.5, 0.95, 1.0])
def test_grouped_percentile_equals_numpy(spark, q):
    rows = _skewed()
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r.g: r.percentile for r in grouped_percentile(df, ["g"], "v", q).collect()}
    groups = {g for g, v in rows if v is not None}
    assert set(got) == groups
    for g in groups:
        want = np.quantile([v for k, v in rows if k == g and v is not None], q)
        assert got[g] == pytest.approx(want, rel=1e-12), g


@pytest.mark.parametrize("value", ["id * 1.0", "1e12 + id", "-1e-9 * id", "exp(id / 200.0)", "if(id = 0, 0, 1e15 + id)", "id % 2 * 1e9 + id"])
def test_grouped_percentile_cuts_a_hot_group(spark, value):
    """No slice of a group may hold more than a small share of the distinct values, wherever these lie."""
    df = spark.range(50_000).select(F.lit("hot").alias("g"), F.expr(value).cast("double").alias("v"), F.lit(1).alias("n"))
    found = _sliced(df, "v", F.col("n") > 0)
    sizes = found.groupBy("g", "slice").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 4 * 50_000 / SLICES and sizes[1] < 3 * SLICES
    # Slices follow the values.
    ends = [(r.a, r.b) for r in found.groupBy("slice").agg(F.min("v").alias("a"), F.max("v").alias("b")).orderBy("slice").collect()]
    assert all(x[1] < y[0] for x, y in zip(ends, ends[1:]))


def test_buckets_never_fall(spark):
    edges = [s * m * 2.0**e for e in (-1074, -1022, -3, 0, 1, 52, 1023) for m in (1, 1 + 2**-52, 2 - 2**-52) for s in (1, -1)]
    values = sorted({*edges, 0.0, float("inf"), -float("inf"), 0.1, 1e308, -1e308})
    df = spark.createDataFrame([(v,) for v in [*values, float("nan")]], "v double").select("v", coarse_bucket(F.col("v")).alias("b"))
    got = [r.b for r in df.orderBy("v").collect()]
    assert got == sorted(got) and len(set(got)) > 20


def test_odd_values_are_ranked_like_others(spark):
    values = [float("inf"), -float("inf"), 0.0, -0.0, 5e-324, 1e308, -1e308, 2.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {q: grouped_percentile(df, [], "v", q).first()[0] for q in (0.0, 1 / 7, 6 / 7, 1.0)}
    assert got == {0.0: -float("inf"), 1 / 7: -1e308, 6 / 7: 1e308, 1.0: float("inf")}


def test_the_plan_does_not_grow_with_the_partitions(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"))

    def plan(partitions):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        try:
            return grouped_percentile(df, ["g"], "v", 0.5)._jdf.queryExecution().optimizedPlan().toString()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)

    assert abs(len(plan(4)) - len(plan(1_000_000))) < 200 and "percentile_approx" not in plan(4)


def test_prefix_totals_equal_running_sums(spark):
    rng = random.Random(5)
    rows = [(k, float(v), rng.randint(0, 9)) for k in ("x", "y", None) for v in rng.sample(range(999), 300)]
    df = spark.createDataFrame(rows, "k string, v double, n bigint")
    for r in prefix_totals(df, ["k"], "v", ["n"]).collect():
        mine = [n for k, v, n in rows if k == r.k and v < r.v]
        assert r.n_below == sum(mine)
        assert r.n_total == sum(n for k, _, n in rows if k == r.k)


@settings(max_examples=8, deadline=None)
@given(
    values=st.lists(st.integers(-3, 3) | st.floats(-1e6, 1e6), min_size=1, max_size=60),
    q=st.floats(0, 1),
)
def test_percentile_property(spark, values, q):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = grouped_percentile(df, [], "v", q).first()[0]
    assert got == pytest.approx(np.quantile(np.array(values, float), q), rel=1e-9, abs=1e-6)


def test_group_metrics_joins_null_groups(frame):
    df = frame("g string, v double, s string", (None, 1.0, "b"), (None, 3.0, "a"), ("k", None, None))
    got = {
        r.g: r
        for r in group_metrics(
            df,
            ["g"],
            [F.count("*").alias("n")],
            distinct={"values": "v"},
            labels={"first": "s"},
            percentiles={"median": ("v", 0.5)},
        ).collect()
    }
    assert tuple(got[None]) == (None, 2, 2, "a", 2.0)
    assert tuple(got["k"]) == ("k", 1, 0, None, None)
