"""Streams against batch: several micro-batches, restarts, late and replayed data."""

import datetime as dt
import re
import time

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from eventide.operators import windows as win
from eventide.operators.clean import clean_windows
from eventide.operators.validate import validate_windows
from eventide.plans import cycle
from eventide.schemas import USER_EVENT
from eventide.sources import events as io
from eventide.sources import testdata as data
from eventide.sources import windows as store
from eventide.streaming import decode, tumbling

SF = "/root/testdata/sf0.001"


def flat(df):
    shown = df.select(
        "window_start",
        "window_end",
        "total_events",
        "unique_users",
        F.round("avg_duration_ms", 6).alias("avg"),
        F.to_json("event_counts").alias("counts"),
        F.to_json("top_pages").alias("pages"),
    )
    return sorted(map(str, shown.collect()))


@pytest.fixture(scope="module")
def slices(spark):
    """The events in four parts of eight days."""
    events = data.user_events(spark, SF)
    day = F.dayofmonth("timestamp")
    return [events.filter((day > 8 * i) & (day <= 8 * i + 8)) for i in range(4)]


def source(spark, path):
    return (
        spark.readStream.schema(USER_EVENT).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")
    )


def add(part, path, number):
    part.coalesce(1).write.parquet(f"{path}/{number}")


def run(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def test_cells_equal_batch_after_restarts(spark, slices, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "cells", "check"))
    for i, part in enumerate(slices[:3]):
        add(part, src, i)
    run(tumbling.start_cells(source(spark, src), out, check, "1 hour"))
    done = slices[0].unionByName(slices[1]).unionByName(slices[2])
    assert flat(tumbling.read_windows(spark, out, "1 hour")) == flat(win.window_aggregate(done, "1 hour"))
    # A restart without new files changes nothing, one with a late file adds it.
    run(tumbling.start_cells(source(spark, src), out, check, "1 hour"))
    assert flat(tumbling.read_windows(spark, out, "1 hour")) == flat(win.window_aggregate(done, "1 hour"))
    add(slices[3], src, 3)
    run(tumbling.start_cells(source(spark, src), out, check, "1 hour"))
    everything = done.unionByName(slices[3])
    expected = flat(win.window_aggregate(everything, "1 hour"))
    assert flat(tumbling.read_windows(spark, out, "1 hour")) == expected

    base = tumbling.compact_cells(spark, out, str(tmp_path / "base"))
    assert base[1] >= 2
    assert flat(tumbling.read_windows(spark, out, "1 hour", base)) == expected
    again = tumbling.compact_cells(spark, out, str(tmp_path / "base2"), base)
    assert flat(tumbling.read_windows(spark, out, "1 hour", again)) == expected


def test_cells_of_unfinished_batches_are_not_read(spark, slices, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "cells", "check"))
    add(slices[0], src, 0)
    run(tumbling.start_cells(source(spark, src), out, check, "1 hour"))
    expected = flat(tumbling.read_windows(spark, out, "1 hour"))
    half = win.window_cells(slices[1], "1 hour").withColumn("day", F.to_date("window_start"))
    half.write.partitionBy("day", "dim").parquet(f"{out}/batch_id=7")
    assert flat(tumbling.read_windows(spark, out, "1 hour")) == expected
    tumbling.note_batch(spark, out, 7)
    assert flat(tumbling.read_windows(spark, out, "1 hour")) != expected


def test_a_day_of_cells_opens_its_folders_only(spark, slices, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "cells", "check"))
    add(slices[0], src, 0)
    run(tumbling.start_cells(source(spark, src), out, check, "1 hour"))
    day = ("2024-01-03", "2024-01-03")
    cells = tumbling.read_cells(spark, out, days=day)
    assert flat(tumbling.read_windows(spark, out, "1 hour", days=day)) == flat(
        win.window_aggregate(slices[0].filter("date(timestamp) = '2024-01-03'"), "1 hour")
    )
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*\(day#\d+ >=", plan)


def test_cells_take_events_in_any_order(spark, slices, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "cells", "check"))
    for i in (3, 0, 2, 1):
        add(slices[i], src, i)
    run(tumbling.start_cells(source(spark, src), out, check, "1 hour"))
    assert flat(tumbling.read_windows(spark, out, "1 hour")) == flat(
        win.window_aggregate(data.user_events(spark, SF), "1 hour")
    )


def test_json_stream_to_windows(spark, slices, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "cells", "check"))
    io.write_json_lines(slices[0], src)
    spark.createDataFrame([("broken",)], "value string").write.mode("append").text(src)
    events = io.accepted_events(io.decode_events(io.read_json_lines(spark, src)))
    run(tumbling.start_cells(events, out, check, "1 hour"))
    assert flat(tumbling.read_windows(spark, out, "1 hour")) == flat(
        win.window_aggregate(slices[0], "1 hour")
    )


def test_stream_windows_by_arrival_time(spark, tmp_path):
    """All events of a file arrive together, whenever they happened."""
    src, out, check = (str(tmp_path / n) for n in ("src", "cells", "check"))
    records = [
        f'{{"id":"{i}","user_id":"u{i}","timestamp":"2024-01-0{i}T00:00:00Z"}}' for i in (1, 2, 3)
    ]
    records.append('{"id":"4","user_id":"u1"}')
    spark.createDataFrame([(r,) for r in records], "value string").coalesce(1).write.text(src)
    decoded = io.decode_events(io.read_json_lines(spark, src))
    events = io.accepted_events(decoded, "arrival")
    run(tumbling.start_cells(events, out, check, "1 hour", time_col="arrival"))
    row = tumbling.read_windows(spark, out, "1 hour").collect()[0]
    assert (row.total_events, row.unique_users) == (4, 3)
    assert row.window_start.year > 2024


def test_closed_windows_appear_once(spark, slices, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "closed", "check"))
    expected = {}
    for i, part in enumerate(slices):
        add(part, src, i)
        run(tumbling.start_closed_windows(source(spark, src), out, check, "1 hour", "10 minutes"))
        seen = part if i == 0 else seen.unionByName(part)
        last = seen.agg(F.max("timestamp")).first()[0]
        last = last.replace(microsecond=last.microsecond // 1000 * 1000)
        closed = win.window_aggregate(seen, "1 hour").filter(
            F.col("window_end") <= F.lit(last - dt.timedelta(minutes=10))
        )
        expected = flat(closed)
        got = store.from_at_rest(store.scan_windows(spark, f"{out}/windows"))
        assert flat(got) == expected
    assert expected


def at(spark, *minutes):
    rows = [
        (str(m), "u", "s", "click", "/", 1.0, None, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m))
        for m in minutes
    ]
    return spark.createDataFrame(rows, USER_EVENT)


def test_closed_windows_drop_late_events(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "closed", "check"))
    for number, minute in enumerate((1, 300, 2, 600)):
        add(at(spark, minute), src, number)
        run(tumbling.start_closed_windows(source(spark, src), out, check, "1 hour", "10 minutes"))
    got = store.scan_windows(spark, f"{out}/windows").orderBy("window_start").collect()
    assert [(r.window_start.hour, r.total_events) for r in got] == [(0, 1), (5, 1)]


def test_quiet_windows_close_while_only_ticks_come(spark, tmp_path):
    """Events end with the second batch; ticks alone carry the stream on, over a restart."""
    src, out, check, beat = (str(tmp_path / n) for n in ("src", "closed", "check", "ticks"))
    ticks = at(spark, *range(0, 600, 30)).select("timestamp")
    add(at(spark, 1, 130), src, 0)
    ticks.filter("timestamp < '2024-01-01T03:00:00'").coalesce(1).write.parquet(f"{beat}/0")

    def go():
        stream = spark.readStream.schema("timestamp timestamp").option("maxFilesPerTrigger", 1).parquet(f"{beat}/*")
        run(tumbling.start_closed_windows(source(spark, src), out, check, "1 hour", "10 minutes", ticks=stream))
        got = tumbling.read_closed_windows(spark, out).orderBy("window_start").collect()
        return [(r.window_start.hour, r.total_events, r.event_counts) for r in got]

    one = '{"click":1}'
    assert go() == [(0, 1, one), (1, 0, "{}")]
    ticks.filter("timestamp >= '2024-01-01T03:00:00'").coalesce(1).write.parquet(f"{beat}/1")
    assert go() == [(0, 1, one), (1, 0, "{}"), (2, 1, one), *[(h, 0, "{}") for h in range(3, 9)]]


def test_clock_closes_windows_by_arrival(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "closed", "check"))
    add(at(spark, 1), src, 0)
    events = source(spark, src).withColumn("arrival", F.current_timestamp())
    query = tumbling.start_closed_windows(
        events, out, check, "1 second", "1 second", time_col="arrival", ticks=tumbling.clock(spark, "arrival"), every="1 second"
    )
    deadline = time.monotonic() + 60
    while time.monotonic() < deadline and sum(p.batchId >= 0 for p in query.recentProgress) < 6:
        time.sleep(1)
    query.stop()
    got = tumbling.read_closed_windows(spark, out).agg(F.sum("total_events").alias("n"), F.count(F.lit(1)).alias("w")).first()
    assert got.n == 1 and got.w > 1


def test_a_batch_of_closed_windows_reads_the_batch_before_it_only(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "closed", "check"))
    for number, minute in enumerate((1, 200, 700)):
        add(at(spark, minute), src, number)
        run(tumbling.start_closed_windows(source(spark, src), out, check, "1 hour", "10 minutes", empty=True))
    # The windows written before are gone; what a batch needs of them is in the last line.
    for written in (tmp_path / "closed" / "windows").glob("batch_id=*/*"):
        written.rename(tmp_path / written.name)
    add(at(spark, 1400), src, 3)
    run(tumbling.start_closed_windows(source(spark, src), out, check, "1 hour", "10 minutes", empty=True))
    empty = store.scan_windows(spark, f"{out}/empty").orderBy("window_start").collect()
    assert [r.window_start.hour for r in empty] == [1, 2, *range(4, 11)]


def test_closed_windows_with_empty_ones_between(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "closed", "check"))
    for number, minute in enumerate((1, 200, 700, 1400)):
        add(at(spark, minute), src, number)
        run(
            tumbling.start_closed_windows(
                source(spark, src), out, check, "1 hour", "10 minutes", empty=True
            )
        )
    got = tumbling.read_closed_windows(spark, out).orderBy("window_start").collect()
    assert [r.window_start.hour for r in got] == list(range(12))
    assert [r.total_events for r in got] == [1, 0, 0, 1, 0, 0, 0, 0, 0, 0, 0, 1]


def test_closed_windows_by_arrival(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "closed", "check"))
    for number, minute in enumerate((1, 300, 900)):
        # Events of another day arrive at these minutes.
        moved = at(spark, minute).withColumn("arrival", F.col("timestamp"))
        moved = moved.withColumn("timestamp", F.lit(dt.datetime(2020, 5, 5)))
        moved.coalesce(1).write.parquet(f"{src}/{number}")
        schema = moved.schema
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*")
        run(
            tumbling.start_closed_windows(
                stream, out, check, "1 hour", "10 minutes", time_col="arrival"
            )
        )
    got = store.scan_windows(spark, f"{out}/windows").orderBy("window_start").collect()
    assert [r.window_start.hour for r in got] == [0, 5]


def test_closed_windows_write_few_files(spark, slices, tmp_path):
    """Whatever the number of shuffle partitions."""
    src, out, check = (str(tmp_path / n) for n in ("src", "closed", "check"))
    for i, part in enumerate(slices[:2]):
        add(part, src, i)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        run(tumbling.start_closed_windows(source(spark, src), out, check, "1 hour", "10 minutes"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    batches = len(list((tmp_path / "closed" / "cells").glob("batch_id=*")))
    cells = list((tmp_path / "closed" / "cells").glob("**/*.parquet"))
    windows = list((tmp_path / "closed" / "windows").glob("**/*.parquet"))
    assert batches and len(cells) <= 3 * tumbling.CELL_FILES * batches
    assert len(windows) <= tumbling.CELL_FILES * batches


def test_decode_stores_every_outcome(spark, tmp_path):
    src, out, check = (str(tmp_path / n) for n in ("src", "out", "check"))
    texts = ['{"id":"1","timestamp":"2024-01-01T00:00:00Z"}', '{"id":"2"}', "broken", '{"id":3}']
    spark.createDataFrame([(t,) for t in texts], "value string").write.text(src)
    for _ in range(2):
        run(decode.start_decode(io.read_json_lines(spark, src), out, check))
    assert {r.outcome: r.n for r in decode.outcome_counts(spark, out).collect()} == {
        "accepted": 1,
        "undated": 1,
        "rejected": 2,
    }
    passing = decode.passing_counts(spark, out).drop("batch_id").collect()
    assert [tuple(r) for r in passing] == [(1, 2, 1)]
    bad = decode.read_outcome(spark, out, "rejected")
    assert {r.value for r in bad.collect()} == {"broken", '{"id":3}'}


def test_counts_in_passing_of_every_batch(spark, tmp_path):
    """A line per batch, equal to what the batch stored; a batch may hold one outcome only."""
    src, out, check = (str(tmp_path / n) for n in ("src", "out", "check"))
    batches = [['{"id":"1","timestamp":"2024-01-01T00:00:00Z"}'] * 3, ["broken"], ["[]", '{"id":"2"}', ""]]
    for texts in batches:
        spark.createDataFrame([(t,) for t in texts], "value string").write.mode("append").text(src)
        run(decode.start_decode(io.read_json_lines(spark, src), out, check))
    lines = {r.batch_id: (r.accepted, r.rejected, r.undated) for r in decode.passing_counts(spark, out).collect()}
    assert lines[0] == (3, 0, 0) and lines[1] == (0, 1, 0)
    stored = spark.read.schema("batch_id long, outcome string").parquet(out).groupBy("batch_id", "outcome").count()
    per_batch = {(r.batch_id, r.outcome): r["count"] for r in stored.collect()}
    for batch_id, line in lines.items():
        assert line == tuple(per_batch.get((batch_id, o), 0) for o in decode.OUTCOMES)


def test_drain_hands_over_each_window_once(spark, tmp_path):
    path, out, check = (str(tmp_path / n) for n in ("w", "out", "check"))
    windows = data.windows(spark, SF)
    n = windows.count()
    store.write_windows(windows, path, "r1")
    run(tumbling.start_drain(spark, path, out, check))
    assert store.scan_windows(spark, out).count() == n
    run(tumbling.start_drain(spark, path, out, check))
    assert store.scan_windows(spark, out).count() == n
    store.write_windows(windows.limit(5), path, "r2")
    run(tumbling.start_drain(spark, path, out, check))
    assert store.scan_windows(spark, out).count() == n + 5
    # A run that is stored again is not handed over again, nor after a new one.
    store.write_windows(windows, path, "r1")
    run(tumbling.start_drain(spark, path, out, check))
    assert store.scan_windows(spark, out).count() == n + 5
    store.write_windows(windows.limit(2), path, "r3")
    run(tumbling.start_drain(spark, path, out, check))
    assert store.scan_windows(spark, out).count() == n + 7


def test_handing_over_keeps_nothing_but_the_checkpoint(spark, tmp_path):
    """After ten batches as much as after two, besides what is handed over."""
    path, out, check = (str(tmp_path / n) for n in ("w", "out", "check"))
    windows = data.windows(spark, SF).limit(3)
    kept = []
    for k in range(10):
        store.write_windows(windows, path, f"r{k}")
        run(tumbling.start_drain(spark, path, out, check))
        kept.append(sorted(p.name for p in tmp_path.iterdir()))
    assert kept[1] == kept[9] == ["check", "out", "w", "w.runs"]
    assert store.scan_windows(spark, out).count() == 30
    assert len(list((tmp_path / "w.runs").glob("run-*/*.parquet"))) == 10


def test_a_cut_off_announcement_is_written_again(spark, tmp_path):
    path = str(tmp_path / "w")
    (tmp_path / "w.runs" / "run-r1" / "_temporary").mkdir(parents=True)
    store.write_windows(data.windows(spark, SF).limit(3), path, "r1")
    assert [r.run_id for r in spark.read.schema(store.RUN_LOG).parquet(f"{path}.runs/run-r1").collect()] == ["r1"]


def test_notes_of_batches_stay_two(spark, tmp_path):
    path = str(tmp_path / "cells")
    assert tumbling.last_batch(spark, path) is None
    for k in range(12):
        tumbling.note_batch(spark, path, k)
        assert tumbling.last_batch(spark, path) == k
    assert len(list((tmp_path / "cells.done").glob("**/*.parquet"))) == 2


def test_cycle_outputs(spark, tmp_path):
    out = str(tmp_path / "out")
    dirty = data.windows_dirty(spark, SF)
    summary = cycle.run_cycle(spark, dirty, out, "r1").first()
    assert summary.total_windows == dirty.count()
    again = cycle.run_cycle(spark, dirty, out, "r1").first()
    assert again == summary
    assert store.scan_windows(spark, f"{out}/windows").count() == summary.total_windows
    clean = spark.read.parquet(f"{out}/windows_clean")
    assert clean.count() < summary.total_windows
    for name in cycle.REPORTS:
        assert spark.read.parquet(f"{out}/reports/{name}").count() > 0
    cycle.write_dashboard(spark, out, "2024-01-01", "2024-01-10")
    for name in cycle.DASHBOARD:
        assert spark.read.parquet(f"{out}/dashboard/{name}").count() > 0


def test_cycle_gate(spark, tmp_path):
    out = str(tmp_path / "out")
    dirty = data.windows_dirty(spark, SF).withColumn(
        "avg_duration_ms", F.when(F.hour("window_start") == 5, -1.0).otherwise(1.0)
    )
    summary = cycle.run_cycle(spark, dirty, out, "r1").first()
    rejected = cycle.rejected(spark, out)
    assert rejected.count() > 0
    assert summary.total_windows == dirty.count() - rejected.count()
    assert rejected.first().errors == ["duration_ms: -1.00 must be >= 0"]
    assert store.load_windows(spark, f"{out}/windows").count() == summary.total_windows


def test_cycle_tells_duplicates_before_cutting_to_milliseconds(spark, tmp_path):
    out = str(tmp_path / "out")
    dirty = data.windows_dirty(spark, SF)
    cycle.run_cycle(spark, dirty, out, "r1")
    accepted = validate_windows(dirty).filter("is_valid").drop("is_valid", "errors")
    expected = clean_windows(accepted).count()
    assert spark.read.parquet(f"{out}/windows_clean").count() == expected
    moved = dirty.filter("seq = 2 AND total_events > 0").count()
    assert moved and expected > dirty.select("window_start").distinct().count() - moved


def test_cycle_reads_its_own_run_only(spark, tmp_path):
    out = str(tmp_path / "out")
    for run_id in ("r1", "r2"):
        cycle.run_cycle(spark, data.windows_dirty(spark, SF), out, run_id)
    files = store.scan_runs(spark, f"{out}/windows", ["r2"]).inputFiles()
    assert files and all("run_id=r2" in f for f in files)


def test_days_can_be_compacted(spark, tmp_path):
    out = str(tmp_path / "out")
    for run_id in ("r1", "r2"):
        cycle.run_cycle(spark, data.windows_dirty(spark, SF), out, run_id)
    for _ in range(2):
        cycle.compact_days(spark, out, "2024-01-11")
    days = cycle.scan_days(spark, out)
    stored = cycle.scan_stored(spark, out).filter("window_date < '2024-01-11'")
    assert days.count() == stored.count() > 0
    plan = days.filter("window_date = '2024-01-05'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_date" in plan
    cycle.write_dashboard(spark, out, "2024-01-01", "2024-01-10", compacted=True)
    one = spark.read.parquet(f"{out}/dashboard/kpi_metrics").collect()
    cycle.write_dashboard(spark, out, "2024-01-01", "2024-01-10")
    assert spark.read.parquet(f"{out}/dashboard/kpi_metrics").collect() == one


def test_cycle_without_windows_is_skipped(spark, tmp_path):
    empty = data.windows_dirty(spark, SF).limit(0)
    assert cycle.run_cycle(spark, empty, str(tmp_path / "out"), "r1") is None
    assert not (tmp_path / "out" / "reports").exists()


def test_cycles_on_a_stream(spark, tmp_path):
    path, out, check = (str(tmp_path / n) for n in ("w", "out", "check"))
    store.write_windows(data.windows(spark, SF), path, "r1")
    run(cycle.start_cycles(spark, path, out, check))
    n = store.scan_windows(spark, f"{out}/windows").count()
    assert n == data.windows(spark, SF).count()
    run(cycle.start_cycles(spark, path, out, check))
    assert store.scan_windows(spark, f"{out}/windows").count() == n
    store.write_windows(data.windows(spark, SF), path, "r1")
    run(cycle.start_cycles(spark, path, out, check))
    assert store.scan_windows(spark, f"{out}/windows").count() == n
    store.write_windows(data.windows(spark, SF).limit(3), path, "r2")
    query = cycle.start_cycles(spark, path, out, check, every="1 second")
    query.processAllAvailable()
    query.stop()
    assert store.scan_windows(spark, f"{out}/windows").count() == n + 3


def test_cycles_take_every_day(spark):
    """All events in windows that pass the gate, the last days of the month too; the part stored twice once."""
    from eventide.plans import catalog

    found = catalog.queries()["cycles_in_turn"](spark, SF).collect()
    judged = validate_windows(data.windows(spark, SF)).filter("is_valid").select("window_start", "total_events")
    parts = {}
    for r in judged.collect():
        n, events = parts.get(min((r.window_start.day - 1) // 8, 3), (0, 0))
        parts[min((r.window_start.day - 1) // 8, 3)] = n + 1, events + r.total_events
    assert len(parts) == 4
    assert sorted((r.total_windows, r.total_events) for r in found) == sorted(parts.values())


def test_closed_windows_are_rolled_up_in_more_tasks_than_files(spark, tmp_path, monkeypatch):
    """However few files hold the windows of a batch, a task folds one shuffle partition of them."""
    src, out, check, beat = (str(tmp_path / n) for n in ("src", "closed", "check", "ticks"))
    add(at(spark, *range(0, 6000, 10)), src, 0)
    at(spark, *range(0, 8000, 60)).select("timestamp").coalesce(1).write.parquet(f"{beat}/0")
    ticks = spark.readStream.schema("timestamp timestamp").parquet(f"{beat}/*")
    task = F.udf(lambda: TaskContext.get().taskAttemptId(), "long").asNondeterministic()
    for name in ("rollup", "quiet_windows"):
        plain = getattr(tumbling, name)
        monkeypatch.setattr(tumbling, name, lambda *a, plain=plain: plain(*a).withColumn("task", task()))
    run(tumbling.start_closed_windows(source(spark, src), out, check, "1 hour", "10 minutes", ticks=ticks, files=2))
    written = spark.read.option("recursiveFileLookup", "true").parquet(f"{out}/windows").collect()
    assert sorted(r.total_events for r in written) == [0] * 32 + [6] * 100
    assert len({r.task for r in written if r.total_events}) > 4
    folders = list((tmp_path / "closed" / "windows").glob("batch_id=*"))
    assert all(len(list(f.glob("*.parquet"))) <= 2 for f in folders)
