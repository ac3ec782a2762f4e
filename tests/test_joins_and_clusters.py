"""Joins with dense cells and hot bits, and clusters along long chains, against brute force."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftspark.functions import processes
from siftspark.operators import clustering, graph, joins, similarity, spatial, structure


def cloud(n, seed, dense=0):
    r = random.Random(seed)
    rows = [(i, r.uniform(-50, 50), r.uniform(-50, 50), r.uniform(-50, 50)) for i in range(n)]
    rows += [(n + i, 7 + r.uniform(0, 0.4), -3 + r.uniform(0, 0.4), r.uniform(0, 0.4)) for i in range(dense)]
    return rows


def near(a, b, cutoff):
    x, y = np.array([p[1:] for p in a]), np.array([p[1:] for p in b])
    q = ((x[:, None] - y[None]) ** 2).sum(2)
    return sorted((a[i][0], b[j][0]) for i, j in zip(*np.nonzero(q <= cutoff * cutoff)))


POINT = "id bigint, x double, y double, z double"


@pytest.mark.parametrize("cutoff, most, sample", [(0.5, 5000, 100_000), (0.5, 20, 400), (3.0, 10, 200), (200.0, 50, 100)])
def test_points_within_a_distance(spark, cutoff, most, sample):
    donors, acceptors = cloud(150, 1, 60), cloud(400, 2, 200)
    frames = [spark.createDataFrame([*rows, (-1, None, 0.0, 0.0), (-2, float("nan"), 0.0, 0.0)], POINT) for rows in (donors, acceptors)]
    found = spatial.within(*frames, cutoff, most, sample)
    assert sorted((r.d, r.a) for r in found.collect()) == near(donors, acceptors, cutoff)
    back = spatial.within(frames[1], frames[0], cutoff, most, sample)  # the other side is the smaller one
    assert sorted((r.a, r.d) for r in back.collect()) == near(donors, acceptors, cutoff)
    assert spatial.within(frames[0].limit(0), frames[1], cutoff).count() == 0


def test_points_on_borders_meet(spark):
    grid = [(i, float(x), float(y), 0.0) for i, (x, y) in enumerate((x, y) for x in range(-6, 7) for y in range(-6, 7))]
    df = spark.createDataFrame(grid, POINT)
    assert sorted((r.d, r.a) for r in spatial.within(df, df, 1.0, 3, 50).collect()) == near(grid, grid, 1.0)


def test_a_dense_cell_is_no_single_task(spark):
    rows = cloud(2000, 3, 3000)
    points = np.array([r[1:] for r in rows])
    tree = spatial.Octree(points, np.repeat([0, 1], 2500), (1.0, 1.0), 0.5, 100)
    df = spark.createDataFrame(rows, POINT)
    keyed = spatial._dealt(df, tree, 1, False, "a")
    sizes = [r["count"] for r in keyed.groupBy("_leaf", "_p0", "_p1").count().collect()]
    assert max(sizes) < 250 and len(tree.crowded) >= 1
    sparse = tree.leaves(points[:2000])
    assert len(np.unique(sparse)) < 500  # wide cells where points are few
    row, _ = tree.reached(points[:2000])
    assert len(row) < 8 * 2000  # and few copies


def test_hydrogen_bonds_sit_on_contacts(spark):
    rows = cloud(30, 5, 40)
    df = spark.createDataFrame(rows, POINT)
    donors = df.select("*", (F.col("x") + 1).alias("bx"), F.col("y").alias("by"), F.col("z").alias("bz"))
    got = structure.hydrogen_bonds(donors, df, 0.3).collect()
    assert sorted((r.d, r.a) for r in got if r.d != r.a) == [p for p in near(rows, rows, 0.3) if p[0] != p[1]]


# --- sets ---------------------------------------------------------------------------------------


def pairs_of(sets_, t, other=None):
    sim = lambda x, y: len(x & y) / len(x | y) if x | y else 0.0
    if other is None:
        return sorted((a, b) for a in sets_ for b in sets_ if a < b and sim(sets_[a], sets_[b]) >= t)
    return sorted((a, b) for a in sets_ for b in other if sim(sets_[a], other[b]) >= t)


@pytest.mark.parametrize("t", [0.3, 0.6, 0.8, 1.0])
@pytest.mark.parametrize("block", [5, 5000])
def test_threshold_pairs_with_a_hot_bit(spark, t, block):
    r = random.Random(int(t * 10))
    sets_ = {i: {1000 + i % 4} | set(r.sample(range(60), r.choice([1, 2, 9, 10, 11]))) for i in range(120)}
    sets_ |= {200: set(), 201: {5}, 202: {5}, 203: {1000}}
    frame = lambda x: spark.createDataFrame([(i, sorted(b)) for i, b in x.items()], "id bigint, bits array<int>")
    got = similarity.threshold_pairs(frame(sets_), t, block=block).collect()
    assert sorted((x.a, x.b) for x in got) == pairs_of(sets_, t)
    few = {i: b for i, b in sets_.items() if i % 7 == 0}
    got = similarity.threshold_pairs(frame(sets_), t, frame(few), block=block).collect()
    assert sorted((x.a, x.b) for x in got) == pairs_of(sets_, t, few)


# --- clusters -----------------------------------------------------------------------------------


def butina(ids, links):
    close = {i: set() for i in ids}
    for a, b in links:
        close[a].add(b)
        close[b].add(a)
    centroid = {}
    order = sorted(ids, key=lambda i: (len(close[i]), i), reverse=True)
    heads = []
    dead = set()
    for i in order:
        if i not in dead:
            heads.append(i)
            dead |= {i} | close[i]
    for i in ids:
        best = [h for h in close[i] if h in heads]
        centroid[i] = i if i in heads else max(best, key=lambda h: (len(close[h]), h))
    return centroid


def clusters(spark, ids, links, **kw):
    nodes = spark.createDataFrame([(i,) for i in ids], "id bigint")
    edges = spark.createDataFrame([(a, b, 0.9) for a, b in links], "a bigint, b bigint, sim double")
    found = clustering.butina(nodes, edges, **kw).collect()
    assert len(found) == len(ids)
    return {r.member: r.centroid for r in found}


def test_a_chain_of_a_thousand(spark):
    links = [(i, i + 1) for i in range(1000)]
    assert clusters(spark, range(1001), links) == butina(range(1001), links)


@pytest.mark.parametrize("small", [4, 100_000])
def test_clusters_of_random_links(spark, small):
    r = random.Random(small)
    ids = list(range(150))
    links = list({tuple(sorted(r.sample(ids, 2))) for _ in range(130)} | {(i, i + 1) for i in range(40, 80)})
    assert clusters(spark, ids, links, rounds=1, small=small) == butina(ids, links)
    assert clusters(spark, ids, []) == {i: i for i in ids}


def test_clusters_of_prints_without_a_table_of_links(spark, monkeypatch):
    r = random.Random(5)
    bits = {i: frozenset(b for b in range(90) if b != 63 and r.random() < 0.12) for i in range(300)}
    bits |= {i: bits[i % 7] for i in range(300, 340)} | {340: frozenset(), 341: frozenset()}
    words = lambda x: [sum(1 << (b - 64 * w) for b in x if b // 64 == w) for w in (0, 1)]
    links = [(a, b) for a, b in itertools.combinations(bits, 2) if bits[a] | bits[b] and len(bits[a] & bits[b]) / len(bits[a] | bits[b]) >= 0.3]
    df = spark.createDataFrame([(i, words(x)) for i, x in bits.items()] + [(342, None)], "id bigint, fp array<bigint>")
    monkeypatch.setattr(clustering, "_between", None)  # the rounds over links
    want = butina([*bits, 342], links)
    for block in (17, 32_768):
        got = clustering.butina_prints(df, 0.3, block=block).collect()
        assert {x.member: x.centroid for x in got} == want and len(got) == len(want)
        sim = lambda a, b: 1.0 if a == b else len(bits[a] & bits[b]) / len(bits[a] | bits[b])
        assert all(abs(x.sim - sim(x.member, x.centroid)) < 1e-12 for x in got)


def test_components_of_text_ids(spark):
    links = spark.createDataFrame([("b", "c"), ("c", "d"), ("x", "y")], "a string, b string")
    assert {r.v: r.root for r in graph.components(links).collect()} == {"b": "b", "c": "b", "d": "b", "x": "x", "y": "x"}


# --- lists in blocks ----------------------------------------------------------------------------


def test_many_targets_go_in_blocks(spark):
    targets = spark.createDataFrame([(f"t{i}",) for i in range(40)], "target string")
    ligands = spark.createDataFrame([(i,) for i in range(5)], "ligand int")
    got = joins.off_target_jobs(targets, ligands, ligands.filter("ligand > 1"), most=7).collect()
    assert sorted((r.target, r.ligand) for r in got) == sorted((f"t{i}", k) for i in range(40) for k in (2, 3, 4))


def test_braces_in_arguments(spark):
    df = spark.createDataFrame([(1, "x")], "id int, name string")
    (r,) = processes.for_each(df, ["printf", "%s", "{name} {id} {{other}} {}"]).collect()
    assert (r.status, r.output) == ("ok", "x 1 {{other}} {}")
