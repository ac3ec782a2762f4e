"""Many runs followed at once, and jobs without completions."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from siftspark.streaming import runs

START = dt.datetime(2024, 3, 1)


def line(run, seq, minute, message):
    return {"run": run, "seq": seq, "ts": (START + dt.timedelta(minutes=minute)).isoformat(), "message": message}


def add(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))
    at = 1_700_000_000 + 60 * len(list(folder.iterdir()))
    os.utime(folder / name, (at, at))  # files are read in order of their time


BATCHES = [
    [line("a", 1, 0, "MODULE library: start"), line("b", 1, 1, "MODULE library: start"), line("a", 2, 2, "10% 1:9=8s"), line(None, 9, 2, "MODULE admet:")],
    [line("a", 2, 2, "10% 1:9=8s"), line("a", 4, 9, "MODULE physchem: start"), line("b", 2, 8, "Batch 1 size: 30"), line("c", 5, 9, "hello")],
    [line("a", 3, 6, "\x1b[1m20% 2:8=7s\x1b[0m"), line("b", 2, 8, "Batch 1 size: 30"), line("a", 5, 12, "Batch 2 size: 12"), line("a", 6, 13, "Batch 3 size: 1")],
]
LATER = [line("c", 6, 300, "MODULE results: start"), line("d", 1, 301, "90% 9:1=1s")]


def shown(rows):
    return {r["run"]: (r["lines"], r["done"], r["percent"], r["current"], list(r["completed"])) for r in rows}


@pytest.fixture()
def follow(spark, tmp_path):
    def go(**kw):
        stream = spark.readStream.schema(runs.RUN_LOG).option("maxFilesPerTrigger", 1).json(str(tmp_path / "log"))
        query = runs.write_updates(runs.follow_runs(stream, **kw), str(tmp_path / "updates"), str(tmp_path / "state"))
        query.awaitTermination()
        assert query.exception() is None
        return spark.read.schema(runs.STATUS + ", batch int").parquet(str(tmp_path / "updates")).collect()

    return go


def test_followed_runs_equal_the_whole_log(spark, tmp_path, follow):
    for k, rows in enumerate(BATCHES):
        add(tmp_path / "log", f"{k}.json", rows)
    updates = follow(late="1 hour", silence_ms=3_600_000)
    assert [sorted(r["run"] for r in updates if r["batch"] == k and not r["silent"]) for k in range(3)] == [["a", "b"], ["a", "b", "c"], ["a"]]  # only runs with news
    whole = spark.read.schema(runs.RUN_LOG).json(str(tmp_path / "log"))
    want = shown(runs.run_states(whole).collect())
    assert want == {"a": (6, 13, 20, "physchem", ["library"]), "b": (2, 30, None, "library", []), "c": (1, 0, None, None, [])}
    assert shown(runs.latest_states(spark, str(tmp_path / "updates")).collect()) == want
    # A new start goes on from the state, and runs that have long said nothing are silent once.
    add(tmp_path / "log", "3.json", LATER)
    more = [r for r in follow(late="1 hour", silence_ms=3_600_000) if r["batch"] > max(u["batch"] for u in updates)]
    assert {r["run"] for r in more if not r["silent"]} == {"c", "d"}
    add(tmp_path / "log", "4.json", [line("d", 2, 460, "95% 9:1=1s"), line("b", 3, 461, "MODULE admet: start")])
    follow(late="1 hour", silence_ms=3_600_000)
    states = runs.latest_states(spark, str(tmp_path / "updates")).collect()
    assert {r["run"]: r["silent"] for r in states} == {"a": True, "b": False, "c": True, "d": False}
    everything = spark.read.schema(runs.RUN_LOG).json(str(tmp_path / "log"))
    assert shown(states) == shown(runs.run_states(everything).collect())


def test_a_run_keeps_no_lines_in_its_state(spark, tmp_path, follow):
    names = []

    class Handle:
        def __getattr__(self, kind):
            return lambda name, schema: names.append((kind, name))

    runs.RunTracker(1).init(Handle())
    assert names == [("getValueState", "sums"), ("getListState", "modules")]
    for k in range(2):
        add(tmp_path / "log", f"{k}.json", [line("a", seq, seq / 10, "Batch 1 size: 3") for seq in range(100 * k, 1000)])
    follow(late="60 days")
    assert shown(runs.latest_states(spark, str(tmp_path / "updates")).collect()) == {"a": (1000, 3000, None, None, [])}


def test_run_states_of_an_empty_log(spark):
    assert runs.run_states(spark.createDataFrame([], runs.RUN_LOG)).count() == 0


def test_overdue_jobs_are_told_once(spark, tmp_path):
    at = lambda hour: START + dt.timedelta(hours=hour)
    jobs = [[(1, at(0)), (2, at(1)), (3, at(2))], [(4, at(30)), (5, at(31))], [(0, at(1000))]]
    done = [[(1, at(3)), (1, at(4)), (2, at(20))], [(4, at(33)), (9, at(30))], [(0, at(1000))]]
    out = []
    for k in range(3):
        spark.createDataFrame(jobs[k], "job bigint, submitted timestamp").write.mode("append").parquet(f"{tmp_path}/jobs")
        spark.createDataFrame(done[k], "job bigint, finished timestamp").write.mode("append").parquet(f"{tmp_path}/done")
        left = spark.readStream.schema("job bigint, submitted timestamp").parquet(f"{tmp_path}/jobs")
        right = spark.readStream.schema("job bigint, finished timestamp").parquet(f"{tmp_path}/done")
        query = runs.write_updates(runs.overdue(left, right, "12 HOURS"), f"{tmp_path}/out", f"{tmp_path}/state", "append")
        query.awaitTermination()
        assert query.exception() is None
        rows = spark.read.schema("job bigint, submitted timestamp, finished timestamp").parquet(f"{tmp_path}/out").collect()
        out.append(sorted((r["job"], r["submitted"], r["finished"]) for r in rows if r["finished"]) + sorted((r["job"], r["submitted"]) for r in rows if not r["finished"]))
    assert out[0] == [(1, at(0), at(3)), (1, at(0), at(4))]
    assert [x[:2] for x in out[1] if len(x) == 2] == [(2, at(1)), (3, at(2))]
    final = [x for x in out[2] if x[0]]
    assert final == [(1, at(0), at(3)), (1, at(0), at(4)), (4, at(30), at(33)), (2, at(1)), (3, at(2)), (5, at(31))]
    table = runs.overdue(*(spark.createDataFrame(sum(x, []), s) for x, s in ((jobs, "job bigint, submitted timestamp"), (done, "job bigint, finished timestamp"))), "12 HOURS")
    assert sorted((r["job"], r["submitted"]) for r in table.filter(F.col("finished").isNull()).collect()) == [(2, at(1)), (3, at(2)), (5, at(31))]
