"""Restarts, progress, late rows, state, tables of latest rows, repeats after the watermark."""

import json
import math

import pytest
from golden import in_tens, pdd_event, pdd_events, write_triggers
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalstats.functions import event_window, generate_id, interval_label, round_half_up, sql
from signalstats.model import JobConfig
from signalstats.operators import rollup, stats
from signalstats.operators.decode import decode_json, metric_rows, valid
from signalstats.operators.dedup import SeenEvents
from signalstats.plans import batch
from signalstats.sources import ledger
from signalstats.sources.ledger import LedgerTable
from signalstats.sources.scratch import new_folder
from signalstats.sources.tables import read_json_values
from signalstats.streaming import late, pipeline, progress, state
from signalstats.streaming.runner import run_forever

MINUTE = 60_000
AT = 1_600_000_200_000


def stream(spark, tmp_path, chunks):
    values = read_json_values(spark, write_triggers(tmp_path / "in", chunks), streaming=True, maxFilesPerTrigger="1")
    return metric_rows(valid(decode_json(values)))


def events(*times):
    return [[pdd_event(AT + t * MINUTE, AT + t * MINUTE, f"L{i}", float(t))] for i, t in enumerate(times)]


# -- progress -------------------------------------------------------------------


def test_one_report_per_trigger_after_restarts(spark, tmp_path):
    """Each start of a job asks for its log; two failures later it is still one log."""
    path, checkpoint, tries, runs = new_folder(spark, "progress"), new_folder(spark, "checkpoint"), [], []
    rows = stream(spark, tmp_path, in_tens(pdd_events()))

    def start():
        progress.record_progress(spark, path)
        tries.append(None)

        def sink(batch_rows, number):
            batch_rows.count()
            if number == len(tries) and number < 3:
                raise RuntimeError("sink is down")

        runs.append(pipeline.writer(rows, "append", checkpoint, "restarted", drain=True).foreachBatch(sink).start())

    spark.streams.resetTerminated()
    try:
        assert run_forever(spark, start, max_restarts=5, pause=0.0) == 2
        log = progress.record_progress(spark, path)
        log.wait(runs[-1])
        done = log.rows().where("query = 'restarted' AND input_rows > 0").collect()
        assert sorted(r.batch_id for r in done) == [0, 1, 2]
        assert sum(r.input_rows for r in done) == len(pdd_events())
    finally:
        progress.stop_recording(spark, path)
        spark.streams.resetTerminated()
    assert progress.record_progress(spark, path) is not log
    progress.stop_recording(spark, path)


def report(**more):
    return json.dumps(
        {"id": "i", "runId": "r", "name": "q", "timestamp": "2024-01-01T00:00:00.000Z", "numInputRows": 7, **more}
    )


def test_offsets_per_partition(spark):
    topic = {"description": "topic", "numInputRows": 7, "inputRowsPerSecond": 1.0}
    first, second = '{"a":{"0":5,"1":9}}', '{"a":{"0":8,"1":10},"b":{"0":2}}'
    files = {"description": "files", "startOffset": '{"logOffset":3}', "endOffset": '{"logOffset":4}', "numInputRows": 11}
    rate = {"description": "rate", "startOffset": "1", "endOffset": "2", "numInputRows": 4}
    other = {"description": "other", "startOffset": "x", "endOffset": "y", "numInputRows": 1}
    held = ['{"a":{"0":8,"1":9}}', '{"a":{"0":8,"1":30},"b":{"0":2}}']
    texts = [
        report(batchId=0, sources=[{**topic, "startOffset": None, "endOffset": first, "latestOffset": held[0]}]),
        report(batchId=1, sources=[{**topic, "startOffset": first, "endOffset": second, "latestOffset": held[1]}]),
        report(batchId=2, sources=[files, rate, other]),
        report(batchId=3, sources=[]),
    ]
    reports = spark.createDataFrame([(t,) for t in texts], "progress string")
    rows = progress.consumption(progress.offset_rows(progress.progress_rows(reports)))
    columns = "batch_id source description topic partition from_offset to_offset rows backlog rows_so_far backlog_change".split()
    found = sorted((tuple(r) for r in rows.select(*columns).collect()), key=repr)
    assert found == sorted(
        [
            (0, 0, "topic", "a", 0, None, 5, None, 3, None, None),
            (0, 0, "topic", "a", 1, None, 9, None, 0, None, None),
            (1, 0, "topic", "a", 0, 5, 8, 3, 0, 3, -3),
            (1, 0, "topic", "a", 1, 9, 10, 1, 20, 1, 20),
            (1, 0, "topic", "b", 0, None, 2, None, 0, None, None),
            (2, 0, "files", None, None, 3, 4, 11, None, 11, None),
            (2, 1, "rate", None, None, 1, 2, 4, None, 4, None),
            (2, 2, "other", None, None, None, None, 1, None, 1, None),
        ],
        key=repr,
    )


# -- late rows and closing ------------------------------------------------------


@pytest.mark.parametrize("closes", ["start", "end"])
def test_late_rows_are_those_that_statistics_lack(spark, tmp_path, closes):
    """Event by event; the windows of five minutes, the watermark 10 minutes behind the latest."""
    rows = stream(spark, tmp_path, events(0, 30, 31, 17, 20, 23, 0, 60, 61, 47, 52))
    folder, checkpoint = new_folder(spark, "late"), new_folder(spark, "checkpoint")
    late.late_rows_to_table(rows, folder, checkpoint, 5, 10, closes).awaitTermination()
    found = late.late_rows(spark, folder, rows.schema).collect()
    assert all(r.watermark == AT + 20 * MINUTE if r.batch < 9 else r.watermark == AT + 50 * MINUTE for r in found)
    aside = sorted((r.event_time - AT) // MINUTE for r in found)
    assert aside == ([0, 17, 20, 23, 47, 52] if closes == "start" else [0, 17, 47])
    result = pipeline.window_statistics(rows, 5, 10, [], closes=closes)
    pipeline.to_table(result, f"{folder}/t", f"{folder}/c", "complete").awaitTermination()
    path, check = f"{folder}/update", f"{folder}/update-check"
    pipeline.to_table(result, path, check, "update").awaitTermination()
    last = spark.read.parquet(path).groupBy("window_start").agg(F.max("samples").alias("n"))
    assert last.agg(F.sum("n")).first()[0] == 11 - len(aside)


def test_final_rows_wait_for_the_end(spark, tmp_path):
    """Windows begin at minutes 0, 30 and 40; the watermark ends at minute 32."""
    rows = stream(spark, tmp_path, events(0, 30, 42, 43))
    for closes, want in (("start", [0, 30]), ("end", [0])):
        folder = new_folder(spark, "final")
        result = pipeline.window_statistics(rows, 5, 8, [], closes=closes)
        pipeline.to_table(result, f"{folder}/t", f"{folder}/c", "append").awaitTermination()
        got = spark.read.schema(result.schema).parquet(f"{folder}/t").collect()
        assert sorted((r.window_start - AT) // MINUTE for r in got) == want
        assert all(r.window_end - r.window_start == 5 * MINUTE for r in got)
    with pytest.raises(ValueError, match="middle"):
        pipeline.window_statistics(rows, 5, 8, [], closes="middle")


def test_jobs_that_write_final_rows_wait_for_the_end():
    cases = [({}, "start"), ({"final_rows": True}, "end"), ({"output_mode": "append"}, "end")]
    cases += [({"final_rows": True, "closes": "start"}, "start"), ({"closes": "end"}, "end")]
    assert all(JobConfig(**settings).closing == want for settings, want in cases)
    assert JobConfig.from_mapping({"closes": "end"}).closing == "end"


def test_late_trigger_that_runs_again(spark, tmp_path):
    """A failure between a trigger's rows and its ledger leaves neither twice."""
    rows = stream(spark, tmp_path, events(0, 30, 31, 0, 1))
    folder, checkpoint = new_folder(spark, "late"), new_folder(spark, "checkpoint")
    late.late_rows_to_table(rows, folder, checkpoint, 5, 10).awaitTermination()
    commits = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/4")
    commits.getFileSystem(spark._jsc.hadoopConfiguration()).delete(commits, True)
    late.late_rows_to_table(rows, folder, checkpoint, 5, 10).awaitTermination()
    assert sorted((r.event_time - AT) // MINUTE for r in late.late_rows(spark, folder, rows.schema).collect()) == [0, 1]


def test_open_keys_and_operators(spark, tmp_path):
    folder = new_folder(spark, "state")
    result = pipeline.window_statistics(stream(spark, tmp_path, events(0, 30, 41, 42)), 5, 10, [])
    pipeline.to_table(result, f"{folder}/t", f"{folder}/c", "append").awaitTermination()
    held = state.open_keys(spark, f"{folder}/c").select("metric", F.unix_millis("_window").alias("at")).collect()
    assert [(r.metric, (r.at - AT) // MINUTE) for r in held] == [("pdd", 40)]
    (operator,) = state.operators(spark, f"{folder}/c").collect()
    assert (operator.operator, operator.partitions) == ("stateStoreSave", 4)
    before = state.open_keys(spark, f"{folder}/c", batch=1)
    assert before.count() == 2


# -- several lengths --------------------------------------------------------------


def test_rolled_up_stream_equals_the_batch(spark, tmp_path):
    rows = spark.range(4000).selectExpr(
        "if(id % 3 = 0, 'a', 'b') AS metric",
        f"{AT - AT % 86_400_000} + id * 100000 AS event_time",
        "if(id % 1000 = 7, double('NaN'), 1e9 + sqrt(id)) AS value",
        "id",
    )
    path = new_folder(spark, "rows")
    for i in range(4):
        rows.where(f"id div 1000 = {i}").coalesce(2).write.mode("append").parquet(path)
    table = spark.read.parquet(path)
    source = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 2).parquet(path)
    result = pipeline.rolled_up_statistics(source, [5, 60, 1440], 60, [])
    folder = new_folder(spark, "rolled")
    pipeline.to_table(result, f"{folder}/t", f"{folder}/c").awaitTermination()
    got = spark.read.schema(result.schema).parquet(f"{folder}/t").orderBy("metric", "window_start").collect()
    days = rollup.roll_up_windows(
        rollup.roll_up_windows(batch.window_partials(table, 5, []), 60, batch.KEY), 1440, batch.KEY
    )
    want = batch.describe_windows(stats.finalize(days), 1440, []).orderBy("metric", "window_start").collect()
    closed = [r for r in want if r.window_end <= AT - AT % 86_400_000 + 3999 * 100_000 - 60 * MINUTE]
    assert len(closed) == 8
    assert [r.asDict() for r in got] == [{c: r[c] for c in result.columns} for r in closed]
    with pytest.raises(ValueError, match="do not nest"):
        pipeline.rolled_up_statistics(source, [5, 12], 60, [])


def test_merge_parts_of_awkward_rows(spark):
    rows = spark.createDataFrame(
        [("a", 0, 1.0), ("a", 0, float("nan")), ("a", 1, float("nan")), ("a", 2, 5.0), ("a", 3, 7.0), ("b", 0, float("nan"))],
        "metric string, part int, value double",
    )
    partial = stats.aggregate(rows, ["metric", "part"])
    merged = rollup.merge_parts(partial, ["metric"], "part").drop("sketch").orderBy("metric").collect()
    want = stats.aggregate(rows, ["metric"]).drop("sketch").orderBy("metric").collect()
    assert [(r.samples, r.min, r.max, r.mean) for r in merged] == [(r.samples, r.min, r.max, r.mean) for r in want]
    assert math.isclose(merged[0].variance, want[0].variance)
    assert merged[1].variance is None


# -- tables of latest rows ----------------------------------------------------------

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def table(spark, path, **options):
    return LedgerTable(spark, path, SCHEMA, ["k"], F.substring("k", 1, 1), **options)


def put(spark, target, number, **rows):
    target.write(spark.createDataFrame(list(rows.items()), "k string, v long"), number)


def values(target, *args):
    return {r.k: r.v for r in target.latest(*args).collect()}


@pytest.mark.parametrize("merge_every", [1, 2, 100])
def test_latest_rows(spark, merge_every):
    path = new_folder(spark, "latest")
    target = table(spark, path, merge_every=merge_every)
    assert values(target) == {}
    put(spark, target, 0, a1=1, a2=2, b1=3)
    put(spark, target, 1, a1=4)
    put(spark, target, 1, a1=5)  # the trigger again
    put(spark, target, 2, c1=6, b1=7)
    target.write(spark.createDataFrame([], SCHEMA), 3)
    target.write(spark.createDataFrame([(None, 8)], SCHEMA), 4)
    want = {"a1": 5, "a2": 2, "b1": 7, "c1": 6, None: 8}
    assert values(target) == values(table(spark, path)) == want
    assert values(target, ["a"]) == {"a1": 5, "a2": 2}
    assert values(target, ["none"]) == {None: 8}
    put(spark, target, 4, z=1)  # the last trigger again, with other rows
    want = {"a1": 5, "a2": 2, "b1": 7, "c1": 6, "z": 1}
    assert values(target) == want
    target.merge(4)
    target.vacuum()
    target.vacuum()
    assert values(target) == want
    put(spark, target, 5, a2=9)
    assert values(target)["a2"] == 9


def test_failed_merge_is_not_seen(spark, monkeypatch):
    path = new_folder(spark, "latest")
    target = table(spark, path)
    put(spark, target, 0, a1=1, b1=2)
    target.merge(0)
    put(spark, target, 1, a1=3)
    with monkeypatch.context() as broken:
        broken.setattr(ledger, "_LEDGER", "no schema")
        broken.setattr(target, "_ledger", lambda: (0, {"a": 0, "b": 0}))
        with pytest.raises(Exception):  # noqa: B017, PT011
            target.merge(1)
    assert values(target) == {"a1": 3, "b1": 2}
    target.merge(1)
    target.vacuum()
    assert values(target) == {"a1": 3, "b1": 2}
    assert sorted(n for kind, n in target._folders() if kind == "base") == [0, 1]


def test_merge_rewrites_touched_shards_only(spark):
    path = new_folder(spark, "latest")
    target = table(spark, path)
    put(spark, target, 0, a1=1, b1=2)
    target.merge(0)
    put(spark, target, 1, b1=3)
    target.merge(1)
    assert target._ledger() == (1, {"a": 0, "b": 1})
    assert values(target) == {"a1": 1, "b1": 3}


def test_stream_to_latest_survives_a_failure(spark, tmp_path):
    rows = stream(spark, tmp_path, in_tens(pdd_events()))
    result = pipeline.window_statistics(rows, 5, 10, [])
    folder = new_folder(spark, "latest")
    target = LedgerTable(spark, f"{folder}/t", result.schema, ["metric", "window_start"], merge_every=1)
    plain, failing = target.write, [True]

    def write(batch_rows, number):
        plain(batch_rows, number)
        if number == 1 and failing.pop():
            raise RuntimeError("after the rows, before the commit")

    target.write = write
    with pytest.raises(Exception, match="before the commit"):
        pipeline.to_latest(result, target, f"{folder}/c").awaitTermination()
    failing.append(False)
    pipeline.to_latest(result, target, f"{folder}/c").awaitTermination()
    spark.streams.resetTerminated()
    got = {r.window_start: r.samples for r in target.latest().collect()}
    table_rows = metric_rows(valid(decode_json(read_json_values(spark, str(tmp_path / "in")))))
    want = {r.window_start: r.samples for r in batch.window_statistics(table_rows, 5, []).collect()}
    assert got == want
    assert target.latest().count() == len(want)


# -- repeats ------------------------------------------------------------------------


def test_repeats_are_dropped_however_late(spark):
    seen = SeenEvents(spark, new_folder(spark, "seen"), merge_every=2)
    kept = []

    def deliver(number, *rows):
        table_rows = spark.createDataFrame(rows, "event_id string, event_time long, x int")
        found = []
        seen.keep(lambda new, _: found.extend((r.event_id, r.event_time) for r in new.collect()))(table_rows, number)
        kept.append(found)
        return sorted(found, key=repr)

    day = 86_400_000
    assert deliver(0, ("a", 5, 1), ("a", 5, 2), ("b", day, 1), (None, 5, 1), (None, 5, 1)) == [("a", 5), ("b", day), (None, 5), (None, 5)]
    assert deliver(1, ("a", 5, 1), ("c", 6, 1)) == [("c", 6)]
    assert deliver(2, ("d", 300 * day, 1), ("e", None, 1)) == [("d", 300 * day), ("e", None)]
    # Three hundred days on, the first ids come again; and the trigger runs twice.
    for _ in range(2):
        assert deliver(3, ("a", 5, 9), ("b", day, 9), ("c", 6, 9), ("f", 5, 1), ("d", 300 * day, 1)) == [("f", 5)]
    assert deliver(4, ("f", 5, 1), ("b", 5, 1)) == [("b", 5)]


def test_index_reads_the_days_of_the_events_only(spark):
    path = new_folder(spark, "seen")
    seen = SeenEvents(spark, path)
    many = spark.range(100).selectExpr("string(id) AS event_id", "id * 86400000 AS event_time")
    seen.keep(lambda new, _: new.count())(many, 0)
    again = spark.createDataFrame([("7", 7 * 86_400_000)], many.schema)
    assert seen.new_events(again, 1).count() == 0
    assert len(seen._index.rows_before(1, ["7"]).inputFiles()) >= 1
    plan = seen._index.rows_before(1, ["7"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


# -- SQL text -------------------------------------------------------------------------


def test_sql_functions_agree_with_the_columns(spark):
    sql.register(spark)
    numbers = [0.0, -0.0, 1.005, -0.125, 0.125, 2.675, -7.0, 1e18, -1e300, float("inf"), float("-inf"), float("nan"), None]
    found = spark.createDataFrame([(x,) for x in numbers], "x double").select(
        F.expr("round_half_up(x)").alias("got"), round_half_up(F.col("x")).alias("want")
    )
    assert all(repr(r.got) == repr(r.want) for r in found.collect())
    times = [0, 1, -1, AT, AT + 59 * MINUTE, -86_400_001]
    for minutes in (0, 1, 5, 59, 60, 61, 119, 120, 1439, 1440, 4000):
        found = spark.createDataFrame([(t,) for t in times], "t long").select(
            F.expr(f"event_window(t, {minutes})").alias("got"), event_window(F.col("t"), minutes).alias("want")
        )
        assert all(tuple(r.got) == tuple(r.want) for r in found.collect())
        found = found.select(
            F.expr("interval_label(got.start_ms, got.end_ms)").alias("got"),
            interval_label(F.col("want.start_ms"), F.col("want.end_ms")).alias("want"),
        )
        assert all(r.got == r.want for r in found.collect())
    with pytest.raises(Exception, match="must not be negative"):
        spark.sql("SELECT event_window_start(id, -1) FROM range(1)").collect()
    ids = spark.createDataFrame([("a",), ("é",), ("",), (None,)], "x string").select(
        F.expr("generate_id(cast(x AS binary))").alias("got"), generate_id(F.col("x")).alias("want")
    )
    assert all(r.got == r.want for r in ids.collect())
