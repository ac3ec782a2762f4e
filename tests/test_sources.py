import pytest
from pyspark.sql import functions as F

from siftspark.functions import scalars
from siftspark.functions.kernels import KernelRegistry
from siftspark.plans import config
from siftspark.plans.active_loop import LoopConfig, run
from siftspark.operators import sampling
from siftspark.sources import commits, reports, text
from siftspark.streaming import progress


def lines(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "row_id bigint, value string")


def test_library_rows(spark):
    df = lines(spark, "CCO m1", "CCO m1", "onlyone", "", "c1ccccc1 123", "a b c")
    good, bad = text.parse_library(df)
    assert [(r.smiles, r.name) for r in good.orderBy("row_id").collect()] == [("CCO", "m1"), ("CCO", "m1"), ("c1ccccc1", "123")]
    assert bad.count() == 3
    assert text.parse_library(df, strict=False)[0].count() == 4


def test_targets_and_titles(spark):
    df = lines(spark, "CC", "", "CO  x y")
    assert [(r.smiles, r.name) for r in text.named_targets(df).orderBy("row_id").collect()] == [("CC", "mol_1"), ("CO", "x")]
    assert [(r.smiles, r.id) for r in text.titled_molecules(df).orderBy("row_id").collect()] == [("CC", "Mol_1"), ("CO", "x y")]


def test_pose_scores(spark):
    files = spark.createDataFrame([("a_out.pdbqt", "MODEL\nREMARK VINA RESULT: -7.5 0 0"), ("b_out.pdbqt", "one line"), ("c_out.pdbqt", "x\na b c N/A")], "file_name string, value string")
    good, bad = text.parse_pose_scores(files)
    assert [tuple(r) for r in good.collect()] == [(-7.5, "a")]
    assert bad.count() == 2


def test_fps_and_bits(spark):
    good, bad = text.parse_fps(lines(spark, "#FPS1", "0f\tid1", "", "lonely"))
    assert [tuple(r) for r in good.collect()] == [("id1", "0f")] and bad.count() == 1
    assert text.parse_sparse_bits(lines(spark, "z,1,5")).first().bits == [1, 5]


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("CC", "a"), ("CO", "b")], "smiles string, name string")
    text.write_library(df, str(tmp_path / "lib"))
    back, bad = text.parse_library(text.numbered_lines(spark, str(tmp_path / "lib")))
    assert sorted((r.smiles, r.name) for r in back.collect()) == [("CC", "a"), ("CO", "b")] and not bad.count()


def test_config():
    assert config.bound("-inf") is None and config.bound(float("inf")) is None and config.bound("3") == 3.0
    c = config.from_mapping({"start": "admet", "physchem": {"MW": [1, "inf"]}})
    assert c.physchem == {"MW": (1.0, None)} and not c.runs("physchem") and c.runs("docking")


def test_scalars(spark):
    df = spark.createDataFrame([("\x1b[31m 12% 34:567=8s\x1b[0m", "Batch size: 254", "ab")], "a string, b string, c string")
    r = df.select(scalars.percent_of(scalars.strip_ansi(F.col("a"))).alias("p"), scalars.batch_size_of(F.col("b")).alias("n"), scalars.char_codes(F.col("c"), "xab", 4).alias("k")).first()
    assert (r.p, r.n) == (12, 254) and r.k == [2 / 3, 1.0, 0.0, 0.0]


def test_kernels(spark):
    k = KernelRegistry()
    df = spark.createDataFrame([("C1CCCCC1",), ("C(",), (None,)], "s string")
    got = [tuple(r) for r in df.select(k.apply("rings", F.col("s")), k.apply("heavy_atoms", F.col("s"))).collect()]
    assert got == [(1.0, 6.0), (None, None), (None, None)]
    with pytest.raises(KeyError, match="no such"):
        k.apply("no such", F.col("s"))


def test_reports(spark):
    top = spark.createDataFrame([(1, "a<b", 0.5)], "rank int, name string, s double")
    assert "a&lt;b" in reports.html_report("x", top) and "a<b" in reports.text_report(top.select("s"), top)


def test_log_stream(spark, tmp_path):
    (tmp_path / "log").mkdir()
    log = [(1, "MODULE library: start"), (2, "Batch size: 30"), (3, "MODULE docking: start"), (4, "Batch size: 50"), (5, "7% 1:2=3s")]
    df = spark.createDataFrame(log, "seq bigint, message string").select("seq", F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ts"), F.lit("info").alias("level"), "message")
    df.write.mode("append").json(str(tmp_path / "log"))
    more = spark.createDataFrame([(6, "Batch size: 40"), (7, "MODULE results: start")], "seq bigint, message string").select("seq", F.lit("2024-01-01 00:00:01").cast("timestamp").alias("ts"), F.lit("info").alias("level"), "message")
    got = {}
    views = {"done": progress.batch_view(100), "modules": progress.transition_view(), "percent": progress.percent_view()}
    for added in (None, more):  # the second run goes on from the state of the first
        if added is not None:
            added.write.mode("append").json(str(tmp_path / "log"))
        for q in progress.follow(progress.read_log(spark, str(tmp_path / "log"), 1), views, lambda name, rows, _: got.__setitem__(name, sorted(tuple(r) for r in rows.collect())), str(tmp_path / "cp")):
            q.awaitTermination(60)
        if added is None:
            assert got == {"done": [(80, 80)], "percent": [(7,)], "modules": [("docking", 3, False, 85), ("library", 1, True, 0)]}
    assert got == {"done": [(120, 100)], "percent": [(7,)], "modules": [("docking", 3, True, 85), ("library", 1, True, 0), ("results", 7, False, 100)]}


def test_active_loop(spark, tmp_path):
    library = spark.range(600).select("id", F.array((F.col("id") % 30).cast("double"), (F.col("id") % 7).cast("double")).alias("features"))
    label = lambda df: df.withColumn("score", -F.get("features", F.lit(0)))
    left = run(library, label, LoopConfig(str(tmp_path), iterations=2, sample=300, hit_share=0.2))
    assert 0 < left.count() < 600
    assert run(library, label, LoopConfig(str(tmp_path), iterations=2, sample=300, hit_share=0.2)).count() == left.count()


def test_jobs_append_once(spark, tmp_path):
    folder = str(tmp_path / "t")
    rows = lambda *ids: spark.createDataFrame([(i, f"x{i}") for i in ids], "id int, name string")
    assert not commits.done(spark, folder, "a")
    assert commits.append(rows(1, 2), folder, "a") and commits.append(rows(3), folder, "b")
    assert not commits.append(rows(1, 2), folder, "a")  # a retry
    asked = []
    assert not commits.append(lambda: asked.append(1), folder, "b") and not asked
    rows(9).write.parquet(f"{folder}/data/job=c")  # a job that was stopped before its manifest
    ids = lambda **kw: sorted(r["id"] for r in commits.read(spark, folder, **kw).collect())
    assert ids() == [1, 2, 3] and ids(jobs=["b"]) == [3]
    assert commits.append(rows(4), folder, "c") and ids() == [1, 2, 3, 4]  # and is started again
    assert commits.append(rows(5).withColumn("extra", F.lit(True)), folder, "d")
    assert sorted((r["id"], r["extra"]) for r in commits.read(spark, folder).filter("id > 3").collect()) == [(4, None), (5, True)]
    commits.forget(spark, folder, "a")
    assert ids() == [3, 4, 5] and commits.append(rows(1), folder, "a") and ids() == [1, 3, 4, 5]
    assert {r["job"]: r["n_rows"] for r in commits.manifests(spark, folder).collect()} == {"a": 1, "b": 1, "c": 1, "d": 1}
    assert commits.append(rows(1).limit(0), folder, "none") and ids() == [1, 3, 4, 5]


def test_gates_are_those_of_the_settings(spark):
    rows = [(i, start, [m for m in config.MODULES if m != left]) for i, (start, left) in enumerate((a, b) for a in config.MODULES for b in config.MODULES)]
    got = config.gates(spark.createDataFrame(rows, "run int, start string, active array<string>")).collect()
    assert len(got) == len(rows) * len(config.MODULES)
    assert all(r["runs"] == config.Config(active=tuple(r["active"]), start=r["start"]).runs(r["module"]) for r in got)


def test_hit_schedules_are_linear(spark):
    df = spark.createDataFrame([("a", 100, 10), ("b", 7, 0), ("c", 3, 9)], "k string, first bigint, last bigint")
    got = sampling.hit_schedules(df, "first", "last", 10).collect()
    assert len(got) == 30 and all(r["n"] == sampling.linear_schedule(r["first"], r["last"], r["iteration"], 10) for r in got)
    assert [r["n"] for r in sampling.hit_schedules(df, "first", "last", 1).filter("k = 'a'").collect()] == [100]
