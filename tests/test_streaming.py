import json
import random

import pytest
from golden import GOLDEN_AVG_P99, FINAL_WINDOWS, STAT_NAMES, call_state_events, in_tens, pdd_event, pdd_events, write_triggers

from signalstats.model import JobConfig
from signalstats.operators.decode import decode_json, metric_rows, observe_rejects, valid
from signalstats.operators.stats import BINS
from signalstats.plans import batch
from signalstats.sources.scratch import new_folder
from signalstats.sources.tables import read_json_values
from signalstats.streaming import pipeline
from signalstats.streaming.progress import ProgressLog
from signalstats.streaming.runner import run_forever

NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
CONFIG = JobConfig(window_minutes=5, watermark_minutes=10)


def source(spark, tmp_path, chunks):
    return read_json_values(spark, write_triggers(tmp_path / "in", chunks), streaming=True, maxFilesPerTrigger="1")


def run(spark, result, mode, name):
    query = pipeline.to_memory(pipeline.writer(result, mode), name)
    try:
        query.processAllAvailable()
        return spark.sql(f"SELECT * FROM {name}")
    finally:
        query.stop()


def metric_stream(spark, tmp_path, chunks):
    return metric_rows(valid(decode_json(source(spark, tmp_path, chunks))))


@pytest.mark.parametrize("no_data", ["true", "false"])
def test_golden_update_mode(spark, conf, tmp_path, no_data):
    conf(NO_DATA, no_data)
    process = pipeline.event_processor(CONFIG)
    rows = run(spark, process(source(spark, tmp_path, in_tens(pdd_events()))), CONFIG.output_mode, f"golden_{no_data}")
    assert rows.count() == 6
    average = spark.sql(f"SELECT avg(stats.p99) FROM golden_{no_data}").head()[0]
    assert round(average, 2) == GOLDEN_AVG_P99


def test_golden_with_final_rows(spark, tmp_path):
    """The rows of update mode, and once more those of the four windows that close."""
    config = JobConfig(window_minutes=5, watermark_minutes=10, final_rows=True, query_name="golden_final")
    tables = {}

    def sink(rows, mode, name):
        tables[name] = new_folder(spark, name)
        return pipeline.to_table(rows, tables[name], new_folder(spark, "checkpoint"), mode, name)

    for query in pipeline.start_job(source(spark, tmp_path, in_tens(pdd_events())), config, sink):
        query.awaitTermination()
    touched = spark.read.parquet(tables["golden_final"])
    final = spark.read.parquet(tables["golden_final.final"])
    assert (touched.count(), final.count()) == (6, 4)
    p99 = [r[0] for r in touched.select("stats.p99").union(final.select("stats.p99")).collect()]
    assert round(sum(p99) / 10, 2) == 6.46
    check_windows(batch.flattened(final).collect(), FINAL_WINDOWS[:4])


def check_windows(rows, expected):
    found = sorted(rows, key=lambda r: r.window_start)
    assert len(found) == len(expected)
    for row, (start, samples, stats, bins) in zip(found, expected):
        assert (row.window_start, row.window_end, row.window_interval) == (start, start + 300_000, "5m")
        assert row.samples == samples
        assert [row[n] for n in STAT_NAMES] == stats
        assert [row[b] for b in BINS] == bins
        assert (row.metric, row.country, row.direction, row.carrier, row.route) == ("pdd", "us", "outbound", "telco_a", "RI1")


def test_append_mode_emits_windows_behind_the_watermark(spark, tmp_path):
    stream = metric_stream(spark, tmp_path, in_tens(pdd_events()))
    rows = run(spark, pipeline.window_statistics(stream, 5, 10), "append", "appended").collect()
    check_windows(rows, FINAL_WINDOWS[:4])


def test_complete_mode(spark, tmp_path):
    stream = metric_stream(spark, tmp_path, in_tens(pdd_events()))
    rows = run(spark, pipeline.window_statistics(stream, 5, 10), "complete", "completed").collect()
    check_windows(rows, FINAL_WINDOWS)


def test_aligned_windows_agree_when_the_length_divides_an_hour(spark, tmp_path):
    stream = metric_stream(spark, tmp_path, in_tens(pdd_events()))
    rows = run(spark, pipeline.aligned_statistics(stream, 5, 10), "append", "aligned").collect()
    check_windows(rows, FINAL_WINDOWS[:4])


def test_output_mode_defaults_to_update():
    assert [pipeline.output_mode(m) for m in ("complete", "append", "update", "other", None)] == [
        "complete",
        "append",
        "update",
        "update",
        "update",
    ]


def test_call_state_events_give_no_rows(spark, tmp_path):
    process = pipeline.event_processor(CONFIG)
    assert run(spark, process(source(spark, tmp_path, [call_state_events()])), "update", "call_states").count() == 0


def late_chunks():
    at = 1_600_000_200_000
    minute = 60_000
    events = [(at, 1.0), (at + 60 * minute, 2.0), (at + 61 * minute, 3.0), (at + 1, 100.0), (at + 120 * minute, 4.0)]
    return [[pdd_event(t, t, f"L{i}", v)] for i, (t, v) in enumerate(events)]


def test_late_rows_are_dropped(spark, tmp_path):
    """The fourth event is an hour behind, two triggers after the watermark moved."""
    stream = metric_stream(spark, tmp_path, late_chunks())
    query = pipeline.to_memory(pipeline.writer(pipeline.window_statistics(stream, 5, 10), "append"), "late")
    query.processAllAvailable()
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in json.loads(p.json)["stateOperators"])
    query.stop()
    rows = spark.sql("SELECT window_start, samples, max FROM late ORDER BY 1").collect()
    assert dropped == 1
    assert [r["max"] for r in rows] == [1.0, 3.0]


def random_chunks(seed=7, chunks=4, size=400):
    rng = random.Random(seed)
    start = 1_600_000_200_000
    made = []
    for chunk in range(chunks):
        events = []
        for i in range(size):
            t = start + chunk * 200_000 + rng.randrange(200_000)
            event = pdd_event(t, t, f"R{chunk}-{i}", round(rng.gauss(0, 2), 3))
            # One carrier holds most rows; some events lack dimensions.
            event["event_dimensions"]["carrier"] = rng.choice(["telco_a"] * 4 + ["telco_b"])
            if rng.random() < 0.2:
                del event["event_dimensions"]["route"]
            if rng.random() < 0.1:
                del event["event_dimensions"]
            events.append(event)
        made.append(events)
    last = start + 10_000_000
    return [*made, [pdd_event(last, last, "push", 1.0)], [pdd_event(last + 1, last + 1, "push2", 1.0)]]


def test_drained_stream_equals_batch(spark, tmp_path):
    chunks = random_chunks()
    stream = metric_stream(spark, tmp_path, chunks)
    result = pipeline.window_statistics(stream, 5, 10)
    path, checkpoint = new_folder(spark, "out"), new_folder(spark, "checkpoint")
    query = pipeline.to_table(result, path, checkpoint, "append", drain=True)
    query.awaitTermination()
    streamed = spark.read.schema(result.schema).parquet(path)
    table = metric_rows(valid(decode_json(read_json_values(spark, str(tmp_path / "in")))))
    whole = batch.window_statistics(table, 5)
    closed = whole.filter("window_start < 1600010000000").select(*sorted(whole.columns))
    found = streamed.select(*sorted(whole.columns))
    assert found.count() == closed.count() > 10
    assert found.exceptAll(closed).count() == 0


def test_update_table_is_replaced_per_trigger(spark, tmp_path):
    result = pipeline.window_statistics(metric_stream(spark, tmp_path, in_tens(pdd_events())), 5, 10)
    path, checkpoint = new_folder(spark, "out"), new_folder(spark, "checkpoint")
    pipeline.to_table(result, path, checkpoint, "update").awaitTermination()
    rows = spark.read.parquet(path)
    assert rows.filter("samples > 0").groupBy("batch").count().count() == 3
    assert rows.count() == 6


def test_restart_continues_from_the_checkpoint(spark, tmp_path):
    """State survives a stop: the second run merges into the first one's windows."""
    chunks = in_tens(pdd_events())
    path, checkpoint = new_folder(spark, "out"), new_folder(spark, "checkpoint")
    for end in (1, 3):
        stream = metric_stream(spark, tmp_path, chunks[:end])
        pipeline.to_table(pipeline.window_statistics(stream, 5, 10), path, checkpoint, "append").awaitTermination()
    check_windows(spark.read.parquet(path).collect(), FINAL_WINDOWS[:4])


def test_rejects_are_observed(spark, tmp_path):
    events = [*pdd_events()[:3], *call_state_events()[:2], "{not json", '{"event_type":"unknown_call_event"}']
    decoded = observe_rejects(decode_json(source(spark, tmp_path, [events])))
    result = pipeline.window_statistics(metric_rows(valid(decoded)), 5, 10)
    query = pipeline.to_memory(pipeline.writer(result, "update"), "observed")
    query.processAllAvailable()
    counts = [p.observedMetrics["rejects"] for p in query.recentProgress if "rejects" in p.observedMetrics]
    query.stop()
    first = counts[0].asDict()
    assert first == {"unsupported": 2, "unknown": 0, "unknown_call_event_type": 1, "failed_to_parse": 1}


def test_run_forever_restarts_after_a_failure(spark, tmp_path):
    failures = iter([True, False])

    def start():
        fail = next(failures)

        def sink(rows, _):
            if fail:
                raise RuntimeError("sink is down")
            rows.count()

        stream = source(spark, tmp_path, in_tens(pdd_events()))
        return stream.writeStream.foreachBatch(sink).trigger(availableNow=True).start()

    spark.streams.resetTerminated()
    assert run_forever(spark, start, max_restarts=3, pause=0.0) == 1
    spark.streams.resetTerminated()


def test_run_forever_gives_up(spark, tmp_path):
    def start():
        def sink(rows, _):
            raise RuntimeError("sink is down")

        return source(spark, tmp_path, in_tens(pdd_events())).writeStream.foreachBatch(sink).start()

    with pytest.raises(Exception, match="sink is down"):
        run_forever(spark, start, max_restarts=1, pause=0.0)
    assert not spark.streams.active
    spark.streams.resetTerminated()


def test_progress_log_keeps_every_report(spark, tmp_path):
    log = ProgressLog(spark, new_folder(spark, "progress"), every=2)
    spark.streams.addListener(log)
    try:
        process = pipeline.event_processor(CONFIG)
        path, checkpoint = new_folder(spark, "out"), new_folder(spark, "checkpoint")
        events = [*pdd_events(), "{not json", *call_state_events()]
        query = pipeline.to_table(
            process(source(spark, tmp_path, in_tens(events))), path, checkpoint, "update", name="watched"
        )
        query.awaitTermination()
        log.wait(query)
    finally:
        spark.streams.removeListener(log)
    kinds = [r.kind for r in log.table().where(f"query_id = '{query.id}'").collect()]
    assert kinds.count("started") == kinds.count("terminated") == 1
    rows = log.rows().where("query = 'watched'").collect()
    assert len(rows) == kinds.count("progress") >= 3
    assert sum(r.input_rows for r in rows) == len(events)
    assert all(r.sources[0].description.startswith("FileStreamSource") for r in rows)
    assert sum(r.observed["rejects"]["failed_to_parse"] for r in rows if r.observed) == 1


def test_complete_mode_keeps_one_table(spark, tmp_path):
    result = pipeline.window_statistics(metric_stream(spark, tmp_path, in_tens(pdd_events())), 5, 10)
    path, checkpoint = new_folder(spark, "out"), new_folder(spark, "checkpoint")
    pipeline.to_table(result, path, checkpoint, "complete").awaitTermination()
    check_windows(spark.read.parquet(path).collect(), FINAL_WINDOWS)


def test_unknown_formats_are_refused():
    with pytest.raises(ValueError, match="xml"):
        pipeline.decoder(JobConfig(payload_format="xml"))
