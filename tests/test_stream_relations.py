"""Stream-stream join and silence alerts on made-up files read one per micro-batch."""

from __future__ import annotations

import os

import pytest

from carebook.session import fresh_dir
from carebook.streaming import relations as rel
from carebook.streaming.sink import drain_and_read, drain_to_parquet
from tests.conftest import T, write_events
from tests.test_streaming import _batches, _e, _stream


@pytest.fixture
def rocks(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", rel.ROCKSDB)
    return session


def _error(i, ts, user=1):
    return _e(i, ts, user, "error")


def _purchase(i, ts, user=1):
    return _e(i, ts, user, "purchase")


def _twin(rows, closed):
    """The batch result: errors not after ``closed`` with their first purchase of the next 2 h."""
    out = []
    for i, ts, user, kind, _, _ in rows:
        if kind == "error" and ts <= closed:
            near = [(t, j) for j, t, u, k, _, _ in rows if k == "purchase" and u == user and user is not None and ts <= t <= ts + (T("2024-01-01 02:00:00") - T("2024-01-01 00:00:00"))]
            first = min(near, default=(None, None))
            out.append((i, user, ts, first[1], first[0]))
    return sorted(out, key=str)


def _resolved(spark, batches):
    folder = _batches(batches)
    out = drain_and_read(spark, rel.errors_resolved(_stream(spark, folder), _stream(spark, folder)), "t-resolved")
    return sorted(map(tuple, out.collect()), key=str)


def test_first_purchase_within_two_hours(spark):
    rows = [_error(1, "2024-01-01 10:00:00"), _purchase(2, "2024-01-01 11:00:00"), _purchase(3, "2024-01-01 10:30:00"), _purchase(4, "2024-01-01 10:30:00"),
            _error(5, "2024-01-01 10:00:00", 2), _purchase(6, "2024-01-01 12:00:00", 2),        # exactly 2 h: resolved
            _error(7, "2024-01-01 10:00:00", 3), _purchase(8, "2024-01-01 12:00:01", 3),        # a second too late
            _error(9, "2024-01-01 10:00:00", 4), _purchase(10, "2024-01-01 09:59:59", 4),       # before it
            _error(11, "2024-01-01 10:00:00", None), _purchase(12, "2024-01-01 10:10:00", None),
            _error(13, "2024-01-01 10:00:00", 5), _purchase(14, "2024-01-01 10:00:00", 5)]      # at once
    clock = [_error(98, "2024-01-01 18:00:00", 9), _purchase(99, "2024-01-01 18:00:00", 9)]     # closes all up to 15:00
    expected = _twin(rows + clock, T("2024-01-01 15:00:00"))
    assert {r[0]: r[3] for r in expected} == {1: 3, 5: 6, 7: None, 9: None, 11: None, 13: 14}
    assert _resolved(spark, [rows, clock]) == expected
    # purchases first, errors later, and each in a batch of its own: the same
    assert _resolved(spark, [[r for r in rows if r[3] == "purchase"], [r for r in rows if r[3] == "error"], clock]) == expected
    assert _resolved(spark, [rows[i::4] for i in range(4)] + [clock]) == expected


def test_late_rows_on_either_side(spark):
    """Four batches: once the watermarks have passed them, an error that comes late is not
    reported, and a purchase that comes late resolves nothing."""
    open_, late = _error(1, "2024-01-01 10:00:00"), _error(2, "2024-01-01 10:01:00", 2)
    clock = [_error(50, "2024-01-02 12:00:00", 9), _purchase(51, "2024-01-02 12:00:00", 9)]
    got = _resolved(spark, [
        [open_, _purchase(20, "2024-01-01 09:00:00", 8)],
        clock,                                                                        # watermarks: 01-02 11:00
        [_error(52, "2024-01-02 12:10:00", 9), _purchase(53, "2024-01-02 12:10:00", 9)],   # error 1 comes out unresolved
        [late, _purchase(21, "2024-01-01 10:30:00"), _purchase(22, "2024-01-01 10:30:00", 2),
         _error(54, "2024-01-02 15:20:00", 9), _purchase(55, "2024-01-02 15:20:00", 9)],
    ])
    assert [(r[0], r[3]) for r in got] == [(1, None), (50, 51), (52, 53)]


def test_restarted_join_repeats_nothing(spark):
    folder = _batches([[_error(1, "2024-01-01 10:00:00"), _purchase(2, "2024-01-01 10:30:00")],
                       [_error(3, "2024-01-01 15:00:00", 2), _purchase(4, "2024-01-01 15:00:00", 3)]])
    out, checkpoint = fresh_dir(spark, "t-join-out"), fresh_dir(spark, "t-join-checkpoint")

    def drain():
        drain_to_parquet(rel.errors_resolved(_stream(spark, folder), _stream(spark, folder)), out, checkpoint)
        return sorted((r.event_id, r.resolution_id) for r in spark.read.parquet(out).collect())

    assert drain() == [(1, 2)]
    path = write_events(folder, [_purchase(5, "2024-01-01 16:00:00", 2), _error(6, "2024-01-01 23:00:00", 9), _purchase(7, "2024-01-01 23:00:00", 9)], name="part-100.parquet")
    os.utime(path, (1_700_010_000, 1_700_010_000))
    assert drain() == [(1, 2), (3, 5)]      # the error kept as state meets the purchase after the restart


def _alerts(session, folder):
    out = drain_and_read(session, rel.silent_persons(_stream(session, folder)), "t-silent")
    return sorted(map(tuple, out.collect()))


SILENT = [_e(1, "2024-01-01 10:00:00"), _e(2, "2024-01-02 10:00:00"), _e(3, "2024-01-06 09:00:00"),      # silent from 01-02 10:00
          _e(4, "2024-01-01 08:00:00", 2), _e(5, "2024-01-04 07:59:59", 2), _e(6, "2024-01-07 07:59:59", 2),  # a second less; exactly 3 days
          _e(7, "2024-01-02 00:00:00", None), _e(8, "2024-01-08 11:00:00", 3)]                             # watermark: 01-08 10:00
EXPECTED = [(1, T("2024-01-02 10:00:00"), T("2024-01-05 10:00:00")), (2, T("2024-01-04 07:59:59"), T("2024-01-07 07:59:59"))]


def test_alerts_do_not_depend_on_batches(rocks):
    by_time = sorted(SILENT, key=lambda r: r[1])
    for batches in ([SILENT], [SILENT[::-1]], [by_time[:3], by_time[3:6], by_time[6:]], [[r] for r in by_time]):
        assert _alerts(rocks, _batches(batches)) == EXPECTED


def test_an_entry_within_the_watermark_prevents_the_alert(rocks):
    folder = _batches([[_e(1, "2024-01-01 10:00:00"), _e(2, "2024-01-04 10:30:00", 2)],      # watermark 01-04 09:30: not yet silent
                       [_e(3, "2024-01-04 09:45:00")],
                       [_e(4, "2024-01-04 12:00:00", 2)],                                      # watermark 11:00
                       [_e(5, "2024-01-03 00:00:00", 3), _e(6, "2024-01-07 10:00:00", 2)]])   # #5 is late: person 3 is never known
    assert _alerts(rocks, folder) == []


def test_restart_repeats_no_alert(rocks):
    folder = _batches([[r] for r in sorted(SILENT, key=lambda r: r[1])])
    out, checkpoint = fresh_dir(rocks, "t-silent-out"), fresh_dir(rocks, "t-silent-checkpoint")

    def drain():
        drain_to_parquet(rel.silent_persons(_stream(rocks, folder)), out, checkpoint)
        return sorted(map(tuple, rocks.read.parquet(out).collect()))

    assert drain() == EXPECTED
    assert drain() == EXPECTED
    path = write_events(folder, [_e(9, "2024-01-20 10:00:00", 9)], name="part-100.parquet")
    os.utime(path, (1_700_010_000, 1_700_010_000))
    assert drain() == sorted([*EXPECTED, (1, T("2024-01-06 09:00:00"), T("2024-01-09 09:00:00")), (2, T("2024-01-07 07:59:59"), T("2024-01-10 07:59:59")),
                              (3, T("2024-01-08 11:00:00"), T("2024-01-11 11:00:00"))])


def test_registered_alerts_leave_the_session_alone(spark):
    from tests.conftest import SMOKE_DIR
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        assert rel.silent_person_stream(spark, SMOKE_DIR).columns == ["user_id", "silent_since", "alert_at"]
        assert "HDFSBacked" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
