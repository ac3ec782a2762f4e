"""Dense networks and trees: gradients, training and scoring against plain NumPy."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftspark.functions import models, networks, training
from siftspark.operators import evaluation


def corners(spark, n=1200, seed=1, flip=0.0):
    """The label is whether both numbers have one sign: no line parts them."""
    rng = np.random.default_rng(seed)
    x = rng.uniform(-1, 1, (n, 2))
    y = ((x[:, 0] > 0) == (x[:, 1] > 0)) ^ (rng.random(n) < flip)
    return spark.createDataFrame([(i, a.tolist(), int(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))], "id int, features array<double>, label int").repartition(3)


def test_gradients_are_those_of_differences():
    net = networks.Network.start([3, 5, 4, 1], 3)
    rng = np.random.default_rng(0)
    x, y, w = rng.normal(size=(20, 3)), rng.integers(0, 2, 20).astype(float), rng.uniform(0.5, 2, 20)
    _, g = net.gradient(x, y, w)
    at = net.flat()
    for k in range(0, at.size, 3):
        step = np.zeros_like(at)
        step[k] = 1e-6
        up, down = (net.like(at + s * step).gradient(x, y, w)[0] for s in (1, -1))
        assert g[k] == pytest.approx((up - down) / 2e-6, rel=1e-4, abs=1e-6)


def test_sums_over_tasks_are_sums_over_rows(spark, monkeypatch):
    monkeypatch.setattr(networks, "SLICE", 7)  # gradients meet in several places
    df = corners(spark, 300)
    net = networks.Network.start([2, 6, 1], 1)
    rows = df.select(F.col("features").alias("_x"), F.col("label").cast("double").alias("_y"), F.col("id").alias("_u"))
    total, loss, g = networks.summed(net, rows, 3.0)
    x, y = np.array([r["features"] for r in df.collect()]), np.array([r["label"] for r in df.collect()], float)
    weight = np.where(y == 1, 3.0, 1.0)
    want, by_row = net.gradient(x, y, weight)
    assert total == pytest.approx(weight.sum()) and loss == pytest.approx(want) and np.allclose(g, by_row)
    some = networks.summed(net, rows, 1.0, 0.3, 5)[0]
    assert 40 < some < 150 and networks.summed(net, rows.limit(0), 1.0)[0] == 0


def test_networks_learn_what_no_line_parts(spark):
    train, test = corners(spark, 1200, 1), corners(spark, 500, 2)
    net, losses = networks.train(train, corners(spark, 300, 3), networks.Training(hidden=(16,), steps=80, rate=0.05))
    auc = lambda df: evaluation.roc_auc(df, "p", "label").first()["auc"]
    assert auc(networks.scored(net, test)) > 0.97
    assert auc(training.scored(training.train(train), test)) < 0.65
    assert losses[-1] < losses[0]


def test_training_stops_when_nothing_is_gained(spark):
    noise = corners(spark, 200, 4, flip=0.5)
    _, losses = networks.train(noise, corners(spark, 200, 5, flip=0.5), networks.Training(hidden=(32,), steps=100, rate=0.1, check=2, patience=2))
    assert len(losses) < 50 and losses[-1] >= min(losses)
    heavy, _ = networks.train(noise, None, networks.Training(hidden=(2,), steps=20, positive_weight=20.0, rate=0.1))
    assert networks.scored(heavy, noise).agg(F.avg("p")).first()[0] > 0.8
    with pytest.raises(ValueError):
        networks.train(noise.limit(0))


def test_models_from_files(spark, tmp_path):
    net = networks.Network.start([3, 4, 1], 2)
    (tmp_path / "net.json").write_text(net.to_json())
    tree = {"kind": "trees", "squash": True, "trees": [{"feature": [1, -1, 0, -1, -1], "threshold": [0.5, 0, 0.0, 0, 0], "left": [1, 0, 3, 0, 0], "right": [2, 0, 4, 0, 0], "value": [0, 1.0, 0, 2.0, -3.0]}]}
    (tmp_path / "tree.json").write_text(json.dumps(tree))
    rows = [("a", [0.1, 0.2, 0.3]), ("b", [1.0, 0.5, -1.0]), ("c", [1.0, 0.6, 0.0]), ("d", [-1.0, 0.6, 0.0]), ("bad", [1.0, None, 0.0]), ("none", None), ("inf", [float("inf"), 0.0, 0.0])]
    df = spark.createDataFrame(rows, "name string, x array<double>")
    paths = [str(tmp_path / n) for n in ("net.json", "tree.json")]
    got = {r["name"]: (r["net"], r["tree"], r["both"]) for r in models.ensemble(df, {"net": paths[:1], "tree": paths[1:], "both": paths}, "x").collect()}
    assert got["bad"] == got["none"] == got["inf"] == (None, None, None)
    squash = lambda v: 1 / (1 + np.exp(-v))
    for (name, x), leaf in zip(rows[:4], [1.0, 1.0, -3.0, 2.0], strict=True):
        hidden = np.maximum(np.array(x) @ net.weights[0] + net.biases[0], 0)
        p = squash((hidden @ net.weights[1] + net.biases[1])[0])
        assert got[name] == pytest.approx((p, squash(leaf), (p + squash(leaf)) / 2))
    assert models.ensemble(df.limit(0), {"net": paths[:1]}, "x").count() == 0
