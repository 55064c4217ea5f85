import math
import random

import pytest
from golden import FINAL_WINDOWS, STAT_NAMES, pdd_events, write_triggers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from signalstats.model import AGGREGATION, PERCENTILES, JobConfig
from signalstats.operators import quantiles, rollup, stats
from signalstats.operators.histogram import bin_index, histogram, histogram_rows
from signalstats.plans import batch
from signalstats.sources.tables import read_json_values


def wanted(values, p):
    return sorted(values)[min(int(p * len(values)), len(values) - 1)]


def table(spark, groups):
    rows = [(key, float(v)) for key, values in groups.items() for v in values]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "key string, value double").repartition(4)


def test_job_on_the_golden_events(spark, tmp_path):
    messages = read_json_values(spark, write_triggers(tmp_path / "in", [pdd_events()]))
    result = batch.call_statistics(messages, JobConfig(window_minutes=5))
    assert [f.name for f in result.schema] == AGGREGATION.names
    assert [f.dataType.simpleString() for f in result.schema] == [f.dataType.simpleString() for f in AGGREGATION]
    rows = result.orderBy("window_start").collect()
    found = [
        (r.window_start, r.samples, [r.stats[n] for n in STAT_NAMES], list(r.histogram)) for r in rows
    ]
    assert found == [tuple(w) for w in FINAL_WINDOWS]
    assert {tuple(r.dimensions) for r in rows} == {("us", "outbound", "telco_a", "RI1")}
    assert len({r.dimension_hash for r in rows}) == 1


@pytest.mark.parametrize("form", [stats.statistics, stats.exact_statistics])
def test_statistics_against_brute_force(spark, form):
    rng = random.Random(3)
    groups = {f"g{n}": [round(rng.gauss(0, 2), 2) for _ in range(n)] for n in (1, 2, 3, 4, 5, 10, 20, 99, 100, 101, 1000)}
    found = {r.key: r for r in form(table(spark, groups), ["key"]).collect()}
    assert set(found) == set(groups)
    for key, values in groups.items():
        r = found[key]
        assert r.samples == len(values)
        for name, p in PERCENTILES.items():
            assert r[name] == pytest.approx(wanted(values, p), abs=1e-9), (key, name)
        mean = sum(values) / len(values)
        variance = sum((v - mean) ** 2 for v in values) / (len(values) - 1) if len(values) > 1 else 0.0
        assert (r.min, r.max) == (min(values), max(values))
        assert r.mean == pytest.approx(mean, abs=0.0051)
        assert r.variance == pytest.approx(variance, abs=0.0051)
        assert r.sd == pytest.approx(math.sqrt(variance), abs=0.0051)
        edges = [-math.inf, -2, -1, 0, 1, 2, math.inf]
        assert [r[b] for b in stats.BINS] == [sum(lo <= v < hi for v in values) for lo, hi in zip(edges, edges[1:])]


@pytest.mark.parametrize("form", [stats.statistics, stats.exact_statistics])
def test_nan_and_null_keys(spark, form):
    rows = spark.createDataFrame([("a", float("nan")), ("a", None), ("b", 1.0), ("b", float("nan")), (None, 2.0), (None, 4.0)], "key string, value double")
    found = {r.key: r for r in form(rows, ["key"]).collect()}
    assert (found["a"].samples, found["a"].min, found["a"].mean, found["a"].p99, found["a"].p90) == (0, 0.0, 0.0, 0.0, None)
    assert (found["b"].samples, found["b"].max, found["b"].variance, found["b"].p90) == (1, 1.0, 0.0, 1.0)
    assert (found[None].samples, found[None].median) == (2, 4.0)


DOUBLES = st.one_of(
    st.floats(allow_nan=False, allow_infinity=True),
    st.sampled_from([0.0, -0.0, 5e-324, -5e-324, 1.7976931348623157e308, 1.0, 1.0000000000000002, 0.9999999999999999, 2.0]),
    st.floats(1.7e9, 1.7e9 + 1),
)


@settings(max_examples=6, deadline=None)
@given(st.lists(DOUBLES, min_size=1, max_size=300))
def test_exact_percentiles_of_any_doubles(spark, values):
    rows = spark.createDataFrame([("k", v) for v in values], "key string, value double")
    r = quantiles.exact_percentiles(rows, ["key"]).head()
    for name, p in PERCENTILES.items():
        assert r[name] == wanted(values, p)


def test_exact_percentiles_of_a_hot_key(spark):
    """One key with most rows, in a band so narrow that two cell levels cannot part it."""
    hot = spark.range(200_000).select(F.lit("hot").alias("key"), (F.lit(1e9) + F.col("id") * 1e-5).alias("value"))
    cold = spark.range(100).select(F.lit("cold").alias("key"), F.col("id").cast("double").alias("value"))
    found = {r.key: r for r in quantiles.exact_percentiles(hot.union(cold), ["key"]).collect()}
    for name, p in PERCENTILES.items():
        assert found["hot"][name] == 1e9 + int(p * 200_000) * 1e-5
        assert found["cold"][name] == float(int(p * 100))


def test_sketch_rank_error(spark):
    n = 200_000
    rows = spark.range(n).select(F.xxhash64("id").cast("double").alias("value"))
    sketch = rows.agg(quantiles.sketch(F.col("value")).alias("s"))
    ps = [0.01, 0.25, 0.5, 0.9, 0.99]
    found = sketch.select(quantiles.sketch_quantiles(F.col("s"), ps)).head()[0]
    for p, value in zip(ps, found):
        assert abs(rows.filter(F.col("value") <= value).count() / n - p) < 0.01


def test_union_of_sketches_equals_sketch_of_union(spark):
    rng = random.Random(5)
    rows = table(spark, {"a": [rng.random() for _ in range(400)], "b": [rng.random() + 0.5 for _ in range(300)]})
    parts = rows.groupBy("key").agg(quantiles.sketch(F.col("value")).alias("s"))
    merged = parts.agg(quantiles.merge_sketches(F.col("s")).alias("s"))
    whole = rows.agg(quantiles.sketch(F.col("value")).alias("s"))
    curve = quantiles.evenly_spaced(F.col("s"), 101)
    assert merged.select(curve).head() == whole.select(curve).head()
    two = parts.groupBy().pivot("key", ["a", "b"]).agg(F.first("s"))
    assert two.select(quantiles.union(F.col("a"), F.col("b")).alias("s")).select(curve).head() == whole.select(curve).head()
    size = merged.select(quantiles.sketch_size(F.col("s")), quantiles.sketch_min(F.col("s")), quantiles.sketch_max(F.col("s")))
    low, high = rows.agg(F.min("value"), F.max("value")).head()
    assert tuple(size.head()) == (700, low, high)


def test_sketches_survive_storage(spark, tmp_path):
    rows = table(spark, {"a": range(100)})
    rows.groupBy("key").agg(quantiles.sketch(F.col("value")).alias("s")).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert stored.select(quantiles.sketch_quantiles(F.col("s"), [0.0, 0.5, 1.0])).head()[0] == [0.0, 50.0, 99.0]


def test_empty_sketch(spark):
    rows = spark.createDataFrame([(float("nan"),)], "value double").agg(quantiles.sketch(F.col("value")).alias("s"))
    r = rows.select(quantiles.sketch_quantiles(F.col("s"), [0.5]), quantiles.sketch_histogram(F.col("s"), [0.0])).head()
    assert tuple(r) == (None, [0.0, 0.0])


def test_rank_bounds():
    with pytest.raises(ValueError):
        quantiles.sketch_quantiles(F.lit(b""), [1.5])
    with pytest.raises(ValueError):
        quantiles.evenly_spaced(F.lit(b""), 1)


def test_rollup_equals_direct(spark):
    rng = random.Random(9)
    start = 1_700_006_400_000
    data = [("m", start + rng.randrange(2 * 86_400_000), 1000 + rng.gauss(0, 3)) for _ in range(1500)]
    rows = spark.createDataFrame(data, "metric string, event_time long, value double").repartition(4)
    five = batch.window_partials(rows, 5, [])
    keys = ["metric", "window_start"]
    days = rollup.roll_up_windows(rollup.roll_up_windows(five, 60, keys), 1440, keys)
    direct = stats.statistics(
        rows.withColumn("window_start", F.col("event_time") - F.pmod("event_time", F.lit(86_400_000))), keys
    )
    found = {r.window_start: r for r in stats.finalize(days).collect()}
    for r in direct.collect():
        assert found[r.window_start] == r


def test_rollup_of_values_far_from_zero(spark):
    rows = table(spark, {"a": [1e9 + i / 10 for i in range(50)], "b": [1e9 + i / 7 for i in range(60)]})
    partial = stats.aggregate(rows, ["key"]).withColumn("all", F.lit(1))
    merged = rollup.roll_up(partial, ["all"]).head()
    values = [r.value - 1e9 for r in rows.collect()]
    mean = sum(values) / len(values)
    assert merged.variance == pytest.approx(sum((v - mean) ** 2 for v in values) / (len(values) - 1), rel=1e-6)


def test_rollup_keeps_empty_keys_empty(spark):
    rows = spark.createDataFrame([("a", float("nan")), ("b", 2.0)], "key string, value double")
    partial = stats.aggregate(rows, ["key"]).withColumn("all", F.lit(1))
    r = rollup.roll_up(partial, ["all"]).head()
    assert (r.samples, r.mean, r.variance) == (1, 2.0, None)


def test_rollup_refuses_windows_that_do_not_nest(spark):
    rows = spark.createDataFrame([("m", 1_700_006_400_000, 1.0)], "metric string, event_time long, value double")
    for stored, wanted in ((5, 7), (25, 60), (60, 5), (360, 60)):
        with pytest.raises(ValueError):
            rollup.roll_up_windows(batch.window_partials(rows, stored, []), wanted, ["metric", "window_start"])
    with pytest.raises(ValueError):
        rollup.roll_up_windows(spark.range(1).withColumn("window_start", F.col("id")), 60, ["window_start"])


def test_window_length_survives_parquet(spark, tmp_path):
    rows = spark.createDataFrame([("m", 1_700_006_400_000, 1.0)], "metric string, event_time long, value double")
    batch.window_partials(rows, 5, []).write.parquet(f"{tmp_path}/rows")
    read = spark.read.parquet(f"{tmp_path}/rows")
    assert rollup.roll_up_windows(read, 60, ["metric", "window_start"]).count() == 1


def test_samples_beyond_an_int(spark):
    partial = stats.aggregate(table(spark, {"a": [1.0, 2.0]}), ["key"])
    many = partial.withColumn("samples", F.lit(3_000_000_000))
    assert stats.finalize(many).head().samples == 3_000_000_000


def test_bins_are_closed_on_the_left(spark):
    rows = spark.createDataFrame([(v,) for v in (-3.0, -2.0, -1.5, 0.0, 1.9999, 2.0, float("nan"), None, float("inf"))], "value double")
    found = [r[0] for r in rows.select(bin_index(F.col("value"), [-2, -1, 0, 1, 2])).collect()]
    assert found == [0, 1, 1, 3, 4, 5, None, None, 5]


@pytest.mark.parametrize("splits", [[0.5], [0.0, 1.0, 2.5], [float(i) / 4 for i in range(-20, 21)]])
def test_histogram_with_any_splits(spark, splits):
    rng = random.Random(11)
    groups = {"a": [rng.gauss(0, 2) for _ in range(200)], "b": [float("nan")], "c": [0.5, 0.5]}
    rows = table(spark, groups)
    found = {r.key: r for r in histogram(rows, ["key"], splits).collect()}
    edges = [-math.inf, *splits, math.inf]
    for key, values in groups.items():
        expected = [float(sum(lo <= v < hi for v in values)) for lo, hi in zip(edges, edges[1:])]
        assert found[key].histogram == expected
        assert found[key].samples == sum(expected)
    sketch = rows.groupBy("key").agg(quantiles.sketch(F.col("value")).alias("s"))
    masses = {r.key: r.h for r in sketch.select("key", quantiles.sketch_histogram(F.col("s"), splits).alias("h")).collect()}
    for key in groups:
        assert masses[key] == pytest.approx(found[key].histogram, abs=1e-6)
    unfolded = histogram_rows(histogram(rows, ["key"], splits), splits)
    assert unfolded.count() == 3 * (len(splits) + 1)
    assert unfolded.filter("lower is null").count() == 3


def test_splits_must_ascend(spark):
    for bad in ([], [1.0, 1.0], [2.0, 1.0]):
        with pytest.raises(ValueError):
            bin_index(F.col("value"), bad)


def test_average_of_nested_field(spark):
    rows = spark.createDataFrame([((1.0,),), ((3.0,),)], "stats struct<p99: double>")
    assert stats.average_of(rows, "stats.p99").head().avg_stats_p99 == 2.0
