"""Streaming jobs on made-up files read one per micro-batch.

The driver's diary has no duplicates and no late rows, so these inputs are
made to fail if deduplication or the watermark were removed.
"""

from __future__ import annotations

import datetime as dt
import os
import tempfile

from carebook.sources.tables import Tables
from carebook.streaming import jobs
from carebook.streaming.sink import drain_and_read
from carebook.streaming.source import read_entries_stream
from tests.conftest import SMOKE_DIR, T, write_customers, write_events


def _batches(batches: list[list[tuple]]) -> str:
    """One parquet file per batch, with increasing modification times."""
    d = tempfile.mkdtemp(prefix="carebook-stream-")
    for i, rows in enumerate(batches):
        path = write_events(d, rows, name=f"part-{i:03d}.parquet")
        os.utime(path, (1_700_000_000 + 100 * i, 1_700_000_000 + 100 * i))
    return d


def _stream(spark, folder):
    return read_entries_stream(spark, folder, glob="*.parquet", max_files_per_trigger=1)


def _e(i, ts, user=1, kind="view"):
    return (i, T(ts), user, kind, 1.0, '{"k": 1}')


def test_late_rows_are_dropped_after_the_watermark(spark):
    # Spark drops a row when its window is already closed by the watermark of
    # the previous micro-batch; a row whose window is still open is counted.
    folder = _batches([
        [_e(1, "2024-01-01 10:00:00"), _e(2, "2024-01-01 11:00:00")],
        [_e(3, "2024-01-02 12:00:00")],                       # watermark -> 2024-01-02 11:00
        [_e(4, "2024-01-02 12:10:00")],                       # 2024-01-01 closes and is emitted
        [_e(5, "2024-01-01 09:00:00"), _e(6, "2024-01-02 12:30:00")],   # #5 is late: dropped
    ])
    got = [tuple(r) for r in drain_and_read(spark, jobs.daily_tally(_stream(spark, folder)), "t-late").collect()]
    # 2024-01-01 closed with its two on-time rows; 2024-01-02 is still open.
    assert got == [(dt.date(2024, 1, 1), "view", 2)]


def test_redelivered_entries_are_dropped(spark):
    folder = _batches([
        [_e(1, "2024-01-01 10:00:00"), _e(2, "2024-01-01 10:05:00")],
        [_e(1, "2024-01-01 10:00:00"), _e(3, "2024-01-01 10:40:00")],    # #1 again
        [_e(2, "2024-01-01 10:05:00"), _e(4, "2024-01-01 10:50:00")],    # #2 again
    ])
    out = drain_and_read(spark, jobs.dedup_entries(_stream(spark, folder)), "t-dedup")
    assert sorted(r.event_id for r in out.collect()) == [1, 2, 3, 4]


def test_only_closed_episodes_are_emitted(spark):
    folder = _batches([
        [_e(1, "2024-01-05 10:00:00"), _e(2, "2024-01-05 12:00:00")],
        [_e(3, "2024-01-05 14:00:01")],
        [_e(4, "2024-01-05 20:00:00", user=2)],              # watermark -> 19:00
    ])
    out = drain_and_read(spark, jobs.closed_episodes(_stream(spark, folder)), "t-episodes")
    assert sorted(tuple(r) for r in out.collect()) == [
        (1, T("2024-01-05 10:00:00"), T("2024-01-05 14:00:00"), 2),
        (1, T("2024-01-05 14:00:01"), T("2024-01-05 16:00:01"), 1),
    ]


def test_enrich_finds_persons_registered_between_batches(spark):
    """A person added while the query runs is found from the next batch on, and
    entries written as unmatched before are kept for later."""
    import shutil
    import time

    from carebook.session import fresh_dir
    from carebook.streaming.sink import read_batches

    d = tempfile.mkdtemp(prefix="carebook-enrich-")
    for t in ("nation", "region"):
        shutil.copy(f"{SMOKE_DIR}/{t}.parquet", f"{d}/{t}.parquet")
    write_customers(d, [1])
    write_events(f"{d}/events.parquet", [_e(1, "2024-01-01 10:00:00"), _e(2, "2024-01-01 11:00:00", user=2), _e(3, "2024-01-01 12:00:00", user=None)], name="part-0.parquet")
    out, checkpoint = fresh_dir(spark, "t-enrich-out"), fresh_dir(spark, "t-enrich-checkpoint")
    entries = read_entries_stream(spark, f"{d}/events.parquet", glob=None)
    schema = jobs._enriched_schema(spark, d)

    def found(matched):
        return sorted(r.event_id for r in read_batches(spark, out, schema, "matched", matched).collect())

    q = jobs.start_enrich(spark, d, entries, out, checkpoint, processing_time="1 second")
    try:
        for _ in range(60):
            if found(True):
                break
            time.sleep(1)
        assert (found(True), found(False)) == ([1], [2, 3])
        write_customers(d, [1, 2])
        write_events(f"{d}/events.parquet", [_e(4, "2024-01-01 13:00:00", user=2)], name="part-1.parquet")
        for _ in range(60):
            if len(found(True)) > 1:
                break
            time.sleep(1)
    finally:
        q.stop()
    assert (found(True), found(False)) == ([1, 4], [2, 3])
    assert [r.event_id for r in jobs.late_matches(spark, d, out).collect()] == [2]


def test_stream_jobs_read_an_events_folder_of_part_files(spark):
    d = tempfile.mkdtemp(prefix="carebook-parts-")
    for part in range(3):
        write_events(f"{d}/events.parquet", [_e(10 * part + i, f"2024-01-0{part + 1} 10:0{i}:00") for i in range(4)],
                     name=f"part-{part}.parquet")
    assert jobs.dedup_entries_stream(spark, d).count() == 12


def test_restarted_stream_resumes_from_its_checkpoint(spark):
    """A query restarted on the same checkpoint (as after a lost driver)
    neither re-emits processed rows nor forgets the ids it has seen."""
    from carebook.session import fresh_dir
    from carebook.streaming.sink import drain_to_parquet

    folder = _batches([[_e(1, "2024-01-01 10:00:00"), _e(2, "2024-01-01 10:05:00")]])
    out, ckpt = fresh_dir(spark, "t-restart-out"), fresh_dir(spark, "t-restart-ckpt")
    drain_to_parquet(jobs.dedup_entries(_stream(spark, folder)), out, ckpt)
    path = write_events(folder, [_e(2, "2024-01-01 10:05:00"), _e(3, "2024-01-01 10:20:00")],
                        name="part-100.parquet")   # #2 redelivered after the restart
    os.utime(path, (1_700_010_000, 1_700_010_000))
    drain_to_parquet(jobs.dedup_entries(_stream(spark, folder)), out, ckpt)
    ids = sorted(r.event_id for r in spark.read.parquet(out).collect())
    assert ids == [1, 2, 3]


def test_copies_of_one_id_are_dropped_in_lanes_first(spark, tmp_path):
    """One id redelivered 4,000 times over eight files: each of the tasks that
    drop copies reads at most a lane of them, and the last step a row per lane."""
    import json
    import subprocess
    import sys

    d = str(tmp_path / "diary")
    for part in range(8):
        rows = [_e(1, "2024-01-01 10:00:00")] * 500 + [_e(100 * part + i + 2, "2024-01-01 10:05:00") for i in range(10)]
        write_events(f"{d}/events.parquet", rows, name=f"part-{part}.parquet")
    assert sorted(r.event_id for r in jobs.dedup_entries_stream(spark, d).collect()) == sorted([1, *(100 * p + i + 2 for p in range(8) for i in range(10))])

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    log = tmp_path / "log"
    log.mkdir()
    # files are not packed together, so that there are eight reading tasks
    out = subprocess.run([sys.executable, "-m", "tests.skew_probe", d, str(log), "dedup_entries_stream", "--conf", "spark.sql.files.openCostInBytes=128m"],
                         cwd=root, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    stages = [(records, top) for _, records, top in json.loads(out.stdout.strip().splitlines()[-1])]
    lanes = [top for records, top in stages if records >= 4000]
    assert lanes and max(lanes) <= 0.55, stages                 # two or three of eight lanes may share a task
    assert any(records == 88 for records, _ in stages), stages  # 8 lanes' copies of id 1, and 80 others


def test_dedup_over_lanes_and_batches(spark):
    """Copies in other files and batches, in the same lane and in others, are dropped; so they are with one lane."""
    folder = _batches([
        [_e(1, "2024-01-01 10:00:00"), _e(1, "2024-01-01 10:00:00"), _e(None, "2024-01-01 10:01:00")],
        [_e(2, "2024-01-01 10:20:00"), _e(1, "2024-01-01 10:00:00"), _e(None, "2024-01-01 10:01:00")],
        [_e(2, "2024-01-01 10:20:00"), _e(3, "2024-01-01 10:40:00")],
        [_e(3, "2024-01-01 10:40:00"), _e(1, "2024-01-01 10:00:00")],
    ])
    for lanes in (1, 2, 32):
        for files in (1, 4):
            stream = read_entries_stream(spark, folder, glob="*.parquet", max_files_per_trigger=files)
            out = drain_and_read(spark, jobs.dedup_entries(stream, lanes=lanes), "t-dedup-lanes")
            assert sorted((r.event_id or 0) for r in out.collect()) == [0, 0, 1, 2, 3]


def test_drains_into_the_callers_folders_go_on_where_they_ended(spark):
    import pytest

    from carebook.session import fresh_dir

    d = tempfile.mkdtemp(prefix="carebook-drains-")
    days = [[_e(10 * day + i, f"2024-01-0{day} {8 + 4 * i:02d}:00:00") for i in range(3)] for day in (1, 2, 3, 4)]

    def arrive(day):
        path = write_events(f"{d}/events.parquet", days[day - 1], name=f"part-{day}.parquet")
        os.utime(path, (1_700_000_000 + 100 * day, 1_700_000_000 + 100 * day))

    streams = {jobs.daily_tally_stream: [1, 3], jobs.dedup_entries_stream: [6, 12], jobs.episodes_stream: [5, 11]}
    folders = {job: (fresh_dir(spark, "t-drain-out"), fresh_dir(spark, "t-drain-chk")) for job in streams}
    for turn, arriving in enumerate(((1, 2), (3, 4))):
        for day in arriving:
            arrive(day)
        for job, rows in streams.items():
            found = job(spark, d, *folders[job], max_files_per_trigger=1)
            assert found.count() == rows[turn], (job.__name__, turn)
    for job, rows in streams.items():  # nothing new: nothing is written again
        assert job(spark, d, *folders[job]).count() == rows[1]
    with pytest.raises(ValueError):
        jobs.episodes_stream(spark, d, out_dir=folders[jobs.episodes_stream][0])


def test_combined_dedup_collapses_massive_redelivery(spark):
    # id 1 is delivered 300 times across three files; ids 2 and 3 once.
    hot = [_e(1, "2024-01-01 10:00:00")] * 100
    folder = _batches([
        hot + [_e(2, "2024-01-01 10:05:00")],
        hot,
        hot + [_e(3, "2024-01-01 13:00:00")],      # watermark -> 12:00: ids 1 and 2 emitted
    ])
    out = drain_and_read(spark, jobs.dedup_entries_combined(_stream(spark, folder)), "t-dedup-combined")
    rows = out.collect()
    assert sorted(r.event_id for r in rows) == [1, 2]      # 3 is still ahead of the watermark
    assert set(out.columns) == {"event_id", "ts", "user_id", "event_type", "value", "props"}


def test_combined_dedup_reduces_copies_before_the_state_shuffle(spark):
    q = (jobs.dedup_entries_combined(read_entries_stream(spark, SMOKE_DIR)).writeStream.format("noop")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    lines = q._jsq.explainInternal(False).splitlines()
    i = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(event_id" in line)
    assert "partial_min" in lines[i + 1]


def test_streams_equal_their_batch_twins(spark):
    """One drain of each stream against the batch job it mirrors:
    closed episodes are exactly the batch episodes ending by the final
    watermark, and the daily tally is the batch count of every closed day."""
    from pyspark.sql import functions as F

    from carebook.plans import history
    from carebook.plans.register import diary_enriched

    t = Tables(spark, SMOKE_DIR)
    watermark = t.events.agg(F.max("ts")).first()[0] - dt.timedelta(hours=1)

    closed = history.care_episodes(spark, SMOKE_DIR).where(F.col("episode_end") <= F.lit(watermark))
    streamed = jobs.episodes_stream(spark, SMOKE_DIR)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, closed.select(*streamed.columns).collect()))

    daily = (t.events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("entries"))
             .where(F.date_add("day", 1).cast("timestamp_ntz") <= F.lit(watermark)))
    tally = jobs.daily_tally_stream(spark, SMOKE_DIR)
    assert sorted(map(tuple, tally.collect())) == sorted(map(tuple, daily.select(*tally.columns).collect()))

    dedup = jobs.dedup_entries_stream(spark, SMOKE_DIR)
    assert dedup.exceptAll(t.events).count() == 0 and t.events.exceptAll(dedup).count() == 0

    enriched = jobs.enrich_stream(spark, SMOKE_DIR)
    batch = diary_enriched(spark, SMOKE_DIR).select(*enriched.columns)
    assert enriched.exceptAll(batch).count() == 0 and batch.exceptAll(enriched).count() == 0


def _register_dir(persons):
    import shutil
    d = tempfile.mkdtemp(prefix="carebook-register-")
    for t in ("nation", "region"):
        shutil.copy(f"{SMOKE_DIR}/{t}.parquet", f"{d}/{t}.parquet")
    write_customers(d, persons)
    return d


def test_register_copy_is_made_anew_only_when_files_change(spark):
    from carebook.streaming.register_copy import RegisterCopy
    d = _register_dir([1, 2, 3])
    copy = RegisterCopy(spark, d, buckets=4)
    assert copy.current().count() == 3
    name = copy._table
    copy.current()
    assert copy._table == name
    write_customers(d, [1, 2, 3, 4])
    os.utime(f"{d}/customer.parquet", (1_800_000_000, 1_800_000_000))
    assert copy.current().count() == 4 and copy._table != name
    assert not spark.catalog.tableExists(name)


def test_a_batch_does_not_shuffle_the_register(spark):
    """The copy is read by bucket: the only exchange below the join with it carries the batch's distinct persons."""
    from carebook.streaming.register_copy import RegisterCopy
    for buckets in (4, None):
        _check_plan(spark, RegisterCopy(spark, _register_dir(list(range(200))), buckets))


def _check_plan(spark, copy):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = Tables(spark, SMOKE_DIR).events
        plan = copy.persons_of(batch)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "c_custkey" in line and "FileScan" in line)
    above = lines[next(i for i, line in enumerate(lines) if "SortMergeJoin" in line) + 1:scan]
    assert "Bucketed: true" in lines[scan] and not any("Exchange" in line for line in above), plan
    assert any("Exchange hashpartitioning(_person" in line for line in lines[scan:]), plan


def test_enrich_writes_each_entry_once_with_a_hot_person(spark):
    from carebook.plans.register import diary_enriched
    from carebook.session import fresh_dir
    from carebook.streaming.sink import finish, read_batches
    d = _register_dir(list(range(50)))
    rows = [_e(i, "2024-01-01 10:00:00", user=7 if i % 3 == 0 else i % 80) for i in range(600)] + [_e(1000, "2024-01-01 10:00:00", user=None)]
    write_events(f"{d}/events.parquet", rows[:300], name="part-0.parquet")
    write_events(f"{d}/events.parquet", rows[300:], name="part-1.parquet")
    out = fresh_dir(spark, "t-enrich-hot")
    finish(jobs.start_enrich(spark, d, read_entries_stream(spark, f"{d}/events.parquet", glob=None, max_files_per_trigger=1), out,
                             fresh_dir(spark, "t-enrich-hot-checkpoint"), available_now=True))
    schema = jobs._enriched_schema(spark, d)
    found, missing = (read_batches(spark, out, schema, "matched", m) for m in (True, False))
    assert found.count() + missing.count() == 601
    batch = diary_enriched(spark, d).select(*found.columns)
    assert found.exceptAll(batch).count() == 0 and batch.exceptAll(found).count() == 0
