"""Molecules, models, programs, the web interface and the command line."""

import json
import threading
import urllib.error
import urllib.request

import pytest
from pyspark.sql import functions as F

from siftspark.functions import models, processes
from siftspark.functions import molecules as m
from siftspark.plans import cli, control
from siftspark.sources import remote


@pytest.mark.parametrize(
    ("a", "b"),
    [("OCC", "CCO"), ("c1ccccc1O", "Oc1ccccc1"), ("C(C)(C)C", "CC(C)C"), ("N1C=CC=C1CC", "CCC1=CC=CN1"), ("[Na+].CC(=O)[O-]", "CC([O-])=O.[Na+]"), ("C1CC1C2CC2", "C2CC2C1CC1"), ("[nH]1cccc1", "c1cc[nH]c1"), ("C%10CC%10", "C1CC1")],
)
def test_canonical_text_does_not_depend_on_the_order(a, b):
    assert m.canonical(a) == m.canonical(b) == m.canonical(m.canonical(a))


@pytest.mark.parametrize("text", ["", "  ", "C(", "C)", "C1CC", "[C", "C==C", "C(C)(C)(C)(C)C", "Xx", "cc", "C-", "C11"])
def test_bad_text_is_no_molecule(text):
    assert m.canonical(text) is None


def test_properties_of_known_molecules():
    aspirin, caffeine = m.properties(m.molecule("CC(=O)Oc1ccccc1C(=O)O")), m.properties(m.molecule("CN1C=NC2=C1C(=O)N(C(=O)N2C)C"))
    assert round(aspirin["MW"], 2) == 180.16 and round(aspirin["TPSA"], 2) == 63.60 and (aspirin["nHD"], aspirin["nRing"], aspirin["nRot"]) == (1, 1, 3)
    assert round(caffeine["MW"], 2) == 194.19 and (caffeine["nRing"], caffeine["MaxRing"], caffeine["nHD"]) == (2, 6, 0)
    assert m.properties(m.molecule("CC(N)C(=O)O"))["nStereo"] == 1 and m.properties(m.molecule("CC(C)C(=O)O"))["nStereo"] == 0
    naphthalene, decalin, cubane = (len(m.molecule(s).rings()) for s in ("c1ccc2ccccc2c1", "C1CCC2CCCCC2C1", "C12C3C4C1C5C2C3C45"))
    assert (naphthalene, decalin, cubane) == (2, 2, 5)


def test_steps_and_patterns():
    assert m.write(m.neutral(m.parse("CC(=O)[O-]"))) == m.canonical("CC(=O)O")
    assert m.write(m.neutral(m.parse("C[N+](=O)[O-]"))) == m.canonical("C[N+](=O)[O-]")
    assert m.write(m.without_salts(m.parse("CCN.Cl"))) == "CCN" and m.write(m.without_salts(m.parse("[Na+].[Cl-]"))) == m.canonical("[Na+].[Cl-]")
    assert m.write(m.without_isotopes(m.parse("[13CH4]"))) == "C" and m.write(m.largest_fragment(m.parse("CCC.CC"))) == "CCC"
    assert m.scaffold("CCc1ccc(CC2CC2)cc1") == m.canonical("c1ccc(CC2CC2)cc1") and m.scaffold("CC(=O)C1CC1C") == m.canonical("C1CC1")
    assert m.matches(m.parse("CCOC(=O)C"), m.pattern("C(=O)O")) and not m.matches(m.parse("CCO"), m.pattern("C=O")) and m.matches(m.parse("c1ccccc1C"), m.pattern("*C"))
    assert not m.matches(m.parse("CCOC"), m.pattern("C[OH]")) and m.matches(m.parse("CCO"), m.pattern("C[OH]"))
    assert m.hashed_bits(m.parse("CCO")) == m.hashed_bits(m.parse("OCC")) != m.hashed_bits(m.parse("CCN"))
    assert m.structure_key("OCC") == m.structure_key("CCO") != m.structure_key("CCN") and m.structure_key("C(") is None


def test_models_guard_and_average(spark, tmp_path):
    for name, spec in (("a", {"kind": "linear", "weights": [1, 1], "bias": 1}), ("b", {"kind": "linear", "weights": [3, 1]})):
        (tmp_path / f"{name}.json").write_text(json.dumps(spec))
    df = spark.createDataFrame([("x", [1.0, 2.0]), ("y", [float("inf"), 1.0]), ("z", [None, 1.0])], "name string, f array<double>")
    got = models.ensemble(df, {"p": [f"{tmp_path}/a.json", f"{tmp_path}/b.json"], "q": [f"{tmp_path}/a.json"]}, "f")
    assert sorted((r.name, r.p, r.q) for r in got.collect()) == [("x", 4.5, 4.0), ("y", None, None), ("z", None, None)]
    assert models.ensemble(df.limit(0), {"p": [f"{tmp_path}/a.json"]}, "f").count() == 0


def test_conformers_are_made_together(monkeypatch):
    from siftspark.functions import molecules as m

    texts = ["CCO", "C1CCCC1", "nothing(", None, "c1ccccc1CC", "CCO", "CCN", "C", "CO.Cl"]
    rounds = []
    monkeypatch.setattr(m, "_relaxed", lambda x, b, f=m._relaxed: rounds.append(len(x)) or f(x, b))
    got = m.conformers_of(texts, 3)
    assert sum(rounds) == 3 * 6 and len(rounds) < 6  # each text once, equal sizes together
    assert got == [list(m.conformers(t, 3)) if t else [] for t in texts] == m.conformers_of(texts, 3, most=1)
    assert [len(x) for x in got] == [3, 3, 0, 0, 3, 3, 3, 3, 3] and got[0] == got[5] != got[6]
    for c in got[1]:
        away = [sum((p - q) ** 2 for p, q in zip(c[i][1:], c[(i + 1) % 5][1:], strict=True)) ** 0.5 for i in range(5)]
        assert all(1.2 < r < 2.0 for r in away), away


def test_programs(spark):
    out = []
    assert processes.run_command(["printf", "a\nb\n"], out.append) == 0 and out == ["a\n", "b\n"]
    with pytest.raises(Exception, match="exit status 3"):
        processes.run_command(["sh", "-c", "exit 3"], out.append)
    df = spark.createDataFrame([(1, "x"), (2, None)], "k int, text string")
    got = processes.for_each(df, ["sh", "-c", "cat; printf {k}"], "text", env=processes.on_gpus(2)).collect()
    assert sorted((r.k, r.status, r.output) for r in got) == [(1, "ok", "x1"), (2, "ok", "2")]


def test_equal_calls_are_made_once_and_each_program_once(spark, tmp_path):
    rows = spark.createDataFrame([(k, ["a b", "bad", None, ""][k % 4], k % 2) for k in range(40)], "k int, text string, side int").repartition(3)
    log = f"{tmp_path}/log"
    chain = [["sh", "-c", f'read -r x; echo "1 $x" >> {log}; [ "$x" = bad ] && exit 3; printf %s "$x"'], ["sh", "-c", f"echo 2 >> {log}; tr a-z A-Z"]]
    got = processes.prepare(rows, chain, "text", timeout=20).collect()
    want = {0: ("ok", "A B"), 1: ("exit 3", ""), 2: ("ok", ""), 3: ("ok", "")}
    assert len(got) == 40 and all((r.status, r.output) == want[r.k % 4] and r.text == ["a b", "bad", None, ""][r.k % 4] for r in got)
    lines = open(log).read().split("\n")[:-1]
    assert len(lines) == 4 + 3, lines
    assert [f.name for f in processes.prepare(rows, chain, "text").schema] == ["k", "text", "side", "status", "output"]
    docked = processes.dock(rows, ["sh", "-c", f"echo 3 >> {log}; printf {{side}}; cat"], "text", "k", workers=2, gpus=1).collect()
    assert sorted((r.k, r.status, r.output) for r in docked) == [(k, "ok", f"{k % 2}" + (["a b", "bad", None, ""][k % 4] or "")) for k in range(40)]
    assert open(log).read().count("3\n") == 4
    assert processes.for_each(rows, ["true"]).filter("status = 'ok'").count() == 40


def ask(port, path, body=None):
    request = urllib.request.Request(f"http://127.0.0.1:{port}{path}", None if body is None else json.dumps(body).encode())
    try:
        with urllib.request.urlopen(request, timeout=20) as answer:
            data = answer.read().decode()
            return answer.status, json.loads(data) if answer.headers["Content-Type"] == "application/json" else data
    except urllib.error.HTTPError as e:
        return e.code, json.loads(e.read())


def test_control(tmp_path):
    made = control.server(str(tmp_path), ["sh", "-c", "echo MODULE library: start; echo '7% 1:2=3s'; echo MODULE docking: start; cat {config}"])
    threading.Thread(target=made.serve_forever, daemon=True).start()
    port = made.server_address[1]
    try:
        assert ask(port, "/api/configs") == (200, []) and ask(port, "/api/config/x")[0] == 404 and ask(port, "/api/config/..%2Fx")[0] == 400
        assert ask(port, "/api/config/one", {"top": 5})[0] == 200 and ask(port, "/api/config/one") == (200, {"top": 5})
        assert ask(port, "/api/start", {"config": "two"})[0] == 404 and ask(port, "/api/stop", {})[0] == 409
        assert ask(port, "/api/start", {"config": "one"}) == (200, {"started": True})
        events = ask(port, "/api/events")[1]
        assert "MODULE docking" in events and '\\"top\\": 5' in events
        status = ask(port, "/api/status")[1]
        assert (status["module"], status["completed"], status["progress"]) == ("docking", ["library"], 85)
        assert "EventSource" in ask(port, "/")[1] and ask(port, "/nothing")[0] == 404
    finally:
        made.shutdown()


def test_command_line(spark, tmp_path):
    (tmp_path / "lib.smi").write_text("CCO a\nCC.O b\nC( c\nCCCc1ccccc1 d\nCCCc1ccccc1 a\nlonely\n")
    cli.main(["library", "--library", f"{tmp_path}/lib.smi", "--out", f"{tmp_path}/one", "--steps", "remove_mixtures"])
    rows = {r.value for r in spark.read.text(f"{tmp_path}/one/library").collect()}
    assert rows == {"CCO a", f"{m.canonical('CCCc1ccccc1')} d"}
    cli.main(["properties", "--library", f"{tmp_path}/one/library", "--out", f"{tmp_path}/props"])
    assert {r.name: r.nRing for r in spark.read.parquet(f"{tmp_path}/props").collect()} == {"a": 0.0, "d": 1.0}
    cli.main(["substructure", "--library", f"{tmp_path}/one/library", "--out", f"{tmp_path}/sub", "--pattern", "c1ccccc1", "--pattern", "C[OH]"])
    assert spark.read.text(f"{tmp_path}/sub/matches").count() == 2
    cli.main(["fingerprints", "--library", f"{tmp_path}/one/library", "--out", f"{tmp_path}/bits"])
    cli.main(["cluster", "--bits", f"{tmp_path}/bits", "--out", f"{tmp_path}/clusters", "--threshold", "0.9"])
    assert spark.read.parquet(f"{tmp_path}/clusters/clusters").filter(F.col("sim") == 1.0).count() == 2


def test_fetch(tmp_path):
    (tmp_path / "a").write_text("x")
    assert remote.fetch(f"file://{tmp_path}/a", f"{tmp_path}/b") and (tmp_path / "b").read_text() == "x"
    (tmp_path / "a").write_text("y")
    assert not remote.fetch(f"file://{tmp_path}/a", f"{tmp_path}/b") and (tmp_path / "b").read_text() == "x"
    with pytest.raises(urllib.error.URLError):
        remote.fetch(f"file://{tmp_path}/none", f"{tmp_path}/c")
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a", "b"]
