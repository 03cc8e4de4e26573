"""python -m carebook: list jobs, run one into parquet."""

from __future__ import annotations

import os
import subprocess
import sys
import tempfile

import pyarrow.parquet as pq

from tests.conftest import ROOT, SMOKE_DIR


def _run(*args):
    return subprocess.run([sys.executable, "-m", "carebook", *args], cwd=ROOT, capture_output=True,
                          text=True, timeout=600)


def test_list_names_every_job():
    from carebook.registry import JOBS
    out = _run("list")
    assert out.returncode == 0
    assert {line.split()[0] for line in out.stdout.splitlines()} == set(JOBS)


def test_run_writes_the_result_once():
    target = os.path.join(tempfile.mkdtemp(prefix="carebook-cli-"), "rollup")
    assert _run("run", "district_rollup", SMOKE_DIR, target).returncode == 0
    table = pq.read_table(target)
    assert table.num_rows > 0 and set(table.column_names) == {"r_name", "n_name", "entries", "grouping_level"}
    assert _run("run", "district_rollup", SMOKE_DIR, target).returncode != 0   # never overwrites


def test_stream_command_drains_and_resumes():
    base = tempfile.mkdtemp(prefix="carebook-cli-stream-")
    out, ckpt = os.path.join(base, "out"), os.path.join(base, "ckpt")
    args = ("stream", "daily_tally", SMOKE_DIR, out, ckpt, "--available-now")
    assert _run(*args).returncode == 0
    first = pq.read_table(out).num_rows
    assert first > 0
    assert _run(*args).returncode == 0          # same checkpoint: nothing new, nothing repeated
    assert pq.read_table(out).num_rows == first


def test_every_job_documents_itself():
    from carebook.registry import JOBS
    assert [n for n, f in JOBS.items() if not (f.__doc__ or "").strip()] == []


def test_parameters_of_a_job():
    import datetime as dt

    import pytest

    from carebook.__main__ import parameters
    assert parameters("diary_entries_between", ["start=2024-01-03", "end=2024-01-04T12:00:00"]) == {
        "start": dt.datetime(2024, 1, 3), "end": dt.datetime(2024, 1, 4, 12)}
    assert parameters("running_and_trailing_load", ["days=3"]) == {"days": 3}
    assert parameters("days_without_entry", ["start=2024-01-02"]) == {"start": dt.date(2024, 1, 2)}
    with pytest.raises(SystemExit):
        parameters("lapsed_persons", ["nothing=1"])


def test_run_with_a_parameter_and_stream_enrich():
    base = tempfile.mkdtemp(prefix="carebook-cli-set-")
    target = os.path.join(base, "days")
    assert _run("run", "days_without_entry", SMOKE_DIR, target, "--set", "end=2024-01-01").returncode == 0
    assert {d.isoformat() for d in pq.read_table(target).column("day").to_pylist()} <= {"2024-01-01"}
    out = os.path.join(base, "enriched")
    assert _run("stream", "enrich", SMOKE_DIR, out, os.path.join(base, "ckpt"), "--available-now").returncode == 0
    assert sorted(os.listdir(os.path.join(out, "batch=0")))[-1] == "matched=true"
