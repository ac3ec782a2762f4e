"""Small literal tables, with nulls, NaN, ties, repeats and empty inputs."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from siftspark.operators import clustering, dedup, evaluation, filters, joins, sampling, scoring, sets, similarity, structure


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_property_vote_counts_missing_as_failed(spark):
    bounds = {"a": (0, 1), "b": (None, 5), "c": (None, float("inf"))}
    df = spark.createDataFrame([(1, 0.5, 5.0, 1.0), (2, float("nan"), 5.0, 1.0), (3, None, None, None), (4, 1.0, 6.0, float("nan"))], "name int, a double, b double, c double")
    assert [r.name for r in filters.property_vote(df, bounds).collect()] == [1]
    assert sorted(r.name for r in filters.property_vote(df, bounds, 2).collect()) == [1, 2]
    assert [r.name for r in filters.all_within(df, bounds).collect()] == [1]
    assert filters.property_vote(df.limit(0), bounds).count() == 0


def test_votes_are_strict(spark):
    df = spark.createDataFrame([(1, 0.5, 0.6, 0.9), (2, 0.6, 0.7, None)], "name int, a double, b double, c double")
    assert [(r.name, r.votes) for r in filters.vote_filter(df, ("a", "b", "c"), 2).orderBy("name").collect()] == [(1, 2), (2, 2)]


def test_numeric_and_finite(spark):
    df = spark.createDataFrame([("1.5",), ("N/A",), ("nan",), (None,)], "s string")
    assert [r.s for r in filters.numeric(df, "s").collect()] == [1.5]
    x = spark.createDataFrame([([1.0, 2.0],), ([1.0, None],), ([float("inf"), 1.0],), ([float("nan")],)], "f array<double>")
    assert x.filter(filters.finite_features("f")).count() == 1


def test_mixtures(spark):
    df = spark.createDataFrame([("C.C",), ("C.O",), ("CC",)], "smiles string")
    assert rows(filters.unmixed(df)) == [("C",), ("CC",)]


def test_first_and_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, None)], "k string, i int, v string")
    assert rows(dedup.first_wins(df, ["k"], F.col("i"))) == [("a", 1, "x"), ("b", 3, None)]
    assert rows(dedup.last_wins(df, ["k"], F.col("i")).filter("k = 'a'")) == [("a", 2, "y")]


@pytest.mark.parametrize(
    ("policy", "want"),
    [
        ("keep_first", [("p", 0.0), ("q", 0.0), ("r", 1.0)]),
        ("mean", [("p", 0.5), ("q", 0.0), ("r", 0.0)]),
        ("remove_all", [("q", 0.0)]),
        ("remove_positive", [("p", 0.0), ("q", 0.0), ("r", -1.0)]),
        ("remove_negative", [("p", 1.0), ("q", 0.0), ("r", 1.0)]),
    ],
)
def test_label_policies(spark, policy, want):
    df = spark.createDataFrame([("p", 0, 1), ("p", 1, 2), ("q", 0, 3), ("q", 0, 4), ("r", 1, 5), ("r", None, 6)], "k string, label int, i int")
    assert rows(dedup.resolve_labels(df, "k", "label", "i", policy).select("k", "label")) == want


def test_label_error_policy(spark):
    df = spark.createDataFrame([("p", 0, 1), ("p", 1, 2)], "k string, label int, i int")
    with pytest.raises(Exception, match="conflicting"):
        dedup.resolve_labels(df, "k", "label", "i", "error").collect()


def test_splits_are_disjoint(spark):
    df = spark.createDataFrame([(1, "test"), (1, "train"), (2, "valid"), (2, "test"), (3, "test"), (4, "train")], "id int, split string")
    history = spark.createDataFrame([(4,)], "id int")
    assert rows(dedup.split_hygiene(df, history=history)) == [(1, "train"), (2, "valid"), (3, "test")]


def test_joins(spark):
    lib = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("c", 3)], "name string, v int")
    sel = spark.createDataFrame([("a",), ("z",)], "name string")
    assert rows(joins.keep_selected(lib, sel)) == [("a", 1), ("a", 1)]
    assert rows(joins.drop_known(lib, sel)) == [("b", 2), ("c", 3)]
    with pytest.raises(Exception, match="no name"):
        joins.must_match(sel, lib, "name").collect()
    one = spark.createDataFrame([(0, "x"), (1, "y")], "row_id int, a string")
    with pytest.raises(ValueError, match="rows"):
        joins.zip_rows(one, one.limit(1))
    merged = joins.merge_votes({"m": lib.dropDuplicates(), "n": lib.filter("v = 2")}, "name", "v")
    assert sorted(tuple(r) for r in merged.collect()) == [("a", 1, None), ("b", 2, 2), ("c", 3, None)]
    twice = joins.merge_votes({"m": lib, "n": lib.filter("v = 1")}, "name", "v")  # repeated keys fan out
    assert sorted(tuple(r) for r in twice.filter("name = 'a'").collect()) == [("a", 1, 1)] * 4


def test_sets(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert sets.concatenate(a, b).count() == 5
    assert rows(sets.common_keys(a, b, F.col("k"))) == [(2,)]
    assert rows(sets.missing_keys(a, b, F.col("k"))) == [(1,)]
    with pytest.raises(ValueError, match="differ"):
        sets.concatenate(a, b.withColumnRenamed("k", "z"))


def brute_pairs(items, t):
    out = []
    for (i, x), (j, y) in itertools.combinations(items, 2):
        sim = len(x & y) / len(x | y) if x | y else 0.0
        if sim >= t:
            out.append((i, j, round(sim, 9)))
    return sorted(out)


@pytest.mark.parametrize("t", [0.5, 0.8, 1.0])
def test_threshold_pairs_equal_brute_force(spark, t):
    rng = random.Random(5)
    items = [(i, frozenset(rng.sample(range(24), rng.randint(0, 12)))) for i in range(120)]
    items += [(200, items[3][1]), (201, frozenset())]
    df = spark.createDataFrame([(i, sorted(x)) for i, x in items], "id int, bits array<int>")
    got = sorted((r.a, r.b, round(r.sim, 9)) for r in similarity.threshold_pairs(df, t).collect())
    assert got == [p for p in brute_pairs(items, t) if p[2] > 0]


def test_bit_tanimoto(spark):
    df = spark.createDataFrame([([True] * 70, [True] * 70), ([False] * 70, [False] * 70), ([True] + [False] * 69, [False] * 69 + [True])], "a array<boolean>, b array<boolean>")
    packed = df.select(similarity.pack_bits(F.col("a"), 70).alias("a"), similarity.pack_bits(F.col("b"), 70).alias("b"))
    assert [r[0] for r in packed.select(similarity.tanimoto(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, 0.0]


def sequential_butina(n, edges):
    near = {i: set() for i in range(n)}
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    order = sorted(range(n), key=lambda i: (len(near[i]), i), reverse=True)
    centroid = {}
    for i in order:
        if i not in centroid:
            centroid[i] = i
            for j in near[i]:
                centroid.setdefault(j, i)
    return centroid


def test_butina_equals_sequential(spark):
    rng = random.Random(2)
    n = 40
    edges = [(a, b) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.06]
    nodes = spark.createDataFrame([(i,) for i in range(n)], "id int")
    got = clustering.butina(nodes, spark.createDataFrame([(a, b, 0.7) for a, b in edges], "a int, b int, sim double"))
    assert {r.member: r.centroid for r in got.collect()} == sequential_butina(n, edges)


def test_composite_and_rank(spark):
    df = spark.createDataFrame([("a", -9.0, 2), ("b", -7.0, None), ("c", -7.0, 0), ("d", -5.0, 1)], "name string, dock_score double, key_residue_hbonds int")
    terms = (scoring.Term("dock_score", 1.0, ascending=False), scoring.Term("key_residue_hbonds", 0.5, fill=0.0), scoring.Term("absent", 1.0))
    got = {r.name: (r.composite_score, r.rank) for r in scoring.ranked(scoring.composite(df, terms)).collect()}
    assert got["a"] == (1.0, 1)
    assert got["b"] == got["c"] == (round(0.5 / 1.5, 6), 2)
    assert got["d"] == (round(0.25 / 1.5, 6), 4)
    assert scoring.ranked(scoring.composite(df.limit(0), terms)).count() == 0


def test_constant_column_scales_to_one(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 3.0)], "name string, dock_score double")
    assert {r.composite_score for r in scoring.composite(df, (scoring.Term("dock_score", 1.0),)).collect()} == {1.0}


def test_desirability_peaks_at_one(spark):
    curve = scoring.CURVES["LogP"]
    top = spark.range(0, 1000).select((F.col("id") / 100 - 2).alias("x")).select(F.max(curve.of(F.col("x")))).first()[0]
    assert abs(top - 1) < 1e-3


def test_weighted_geomean(spark):
    df = spark.createDataFrame([(0.5, 0.25), (0.0, 0.5)], "a double, b double")
    got = [r[0] for r in df.select(scoring.weighted_geomean({"a": F.col("a"), "b": F.col("b")}, {"a": 1.0, "b": 3.0})).collect()]
    assert math.isclose(got[0], math.exp((math.log(0.5) + 3 * math.log(0.25)) / 4)) and got[1] is None


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.8, 1), (0.1, 0), (None, 1), (0.3, None)], "s double, y int")
    assert evaluation.roc_auc(df, "s", "y").first()[0] == (1 + 1 + 0.5 + 1) / 4
    assert evaluation.roc_auc(df.filter("y = 1"), "s", "y").first()[0] is None


def test_lowered_cutoff_equals_the_loop(spark):
    values = [random.Random(i).uniform(-10, -2) for i in range(60)]
    df = spark.createDataFrame([(v,) for v in values], "s double")
    for good in (0, 5, 59, 100):
        cutoff, n = sum(values) / len(values), len(values)
        while n > good:
            cutoff -= 0.005
            n = sum(v < cutoff for v in values)
        got = evaluation.lowered_cutoff(df, "s", good).first()
        assert abs(got.cutoff - cutoff) < 1e-6


def test_folds_balance_and_keep_groups(spark):
    df = spark.createDataFrame([(g,) for g, n in (("a", 9), ("b", 5), ("c", 4), ("d", 1)) for _ in range(n)], "g string")
    got = {r.g: r.fold for r in sampling.group_folds(df, "g", 2).collect()}
    assert got == {"a": 0, "b": 1, "c": 1, "d": 0}


def test_folds_equal_the_greedy_pass(spark):
    rng = random.Random(4)
    sizes = [int(rng.paretovariate(0.7)) for _ in range(300)] + [500]
    names = [f"g{i:03d}" for i in range(len(sizes))]
    rows = spark.createDataFrame(list(zip(names, sizes, strict=True)), "g string, n int").select("g", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(5000)))).alias("i"))
    want, loads = {}, [0] * 7
    for n, g in sorted((-min(n, 5000), g) for n, g in zip(sizes, names, strict=True)):
        want[g] = loads.index(min(loads))
        loads[want[g]] -= n
    assert {r.g: r.fold for r in sampling.group_folds(rows, "g", 7).collect()} == want


def test_a_shard_of_few_keys_is_taken_whole(spark):
    df = spark.range(4000).select(F.lit(0).alias("shard"), (F.col("id") % 3).alias("id"))
    sizes = spark.createDataFrame([(0, 900, 300, 300)], "shard int, n_train bigint, n_valid bigint, n_test bigint")
    for seed in range(4):
        got = {r.split: r["count"] for r in sampling.stratified_split(df, "shard", "id", sizes, seed).groupBy("split").count().collect()}
        assert got == {"train": 900, "valid": 300, "test": 300}


def test_stratified_split_sizes(spark):
    df = spark.range(1000).select("id", (F.col("id") % 2).alias("shard"))
    sizes = spark.createDataFrame([(0, 30, 10, 10), (1, 5, 5, 5)], "shard bigint, n_train bigint, n_valid bigint, n_test bigint")
    got = sampling.stratified_split(df, "shard", "id", sizes, 1)
    assert got.select("id").distinct().count() == 65
    assert rows(got.groupBy("shard", "split").count()) == [(0, "test", 10), (0, "train", 30), (0, "valid", 10), (1, "test", 5), (1, "train", 5), (1, "valid", 5)]


def test_rebalance(spark):
    df = spark.createDataFrame([(i, int(i < 7)) for i in range(30)], "id int, y int")
    assert {r.y: r["count"] for r in sampling.rebalance(df, "y", "id", 1).groupBy("y").count().collect()} == {0: 23, 1: 23}
    assert {r.y: r["count"] for r in sampling.downsample(df, "y", "id", 1).groupBy("y").count().collect()} == {0: 7, 1: 7}
    draws = sampling.draws_with_replacement(df, "y", "id", 3, 1).groupBy("y").agg(F.sum("n_draws").alias("n")).collect()
    assert {r.y: r.n for r in draws} == {0: 21, 1: 21}


def test_contacts_equal_brute_force(spark):
    rng = random.Random(1)
    pts = [(i, rng.uniform(-1, 1), rng.uniform(-1, 1), rng.uniform(-1, 1)) for i in range(80)]
    df = spark.createDataFrame(pts, "id int, x double, y double, z double")
    got = sorted((r.d, r.a) for r in structure.contacts(df.filter("id < 40"), df.filter("id >= 40"), 0.5).collect())
    want = sorted((p[0], q[0]) for p in pts[:40] for q in pts[40:] if math.dist(p[1:], q[1:]) <= 0.5)
    assert got == want


def test_inchikey_layers(spark):
    df = spark.createDataFrame([("AAAA-BBBB-N",)], "k string")
    assert tuple(df.select(*[sets.inchikey_layer(F.col("k"), n) for n in (1, 2, 3)]).first()) == ("AAAA", "AAAA-BBBB", "AAAA-BBBB-N")


def test_model_selection_and_schedule(spark):
    assert [sampling.linear_schedule(100, 10, i, 4) for i in (1, 2, 4)] == [100, 70, 10]
    assert sampling.linear_schedule(7, 3, 1, 1) == 7 and [sampling.linear_schedule(0, 9, i, 10) for i in (1, 10)] == [0, 9]
    models = spark.createDataFrame([(i, 1.0, 0.9 - i / 100, 0.5 + i / 10, 0.8, 0.8) for i in range(4)], "model_no int, cutoff double, re_te double, pr_te double, re_vl double, re_pr double")
    got = evaluation.select_models(models, 0.95).collect()
    assert [(r.model_no, r.place) for r in got] == [(1, 1)]
    eer = evaluation.equal_error_rate(spark.createDataFrame([(0.1, 0), (0.2, 0), (0.8, 1), (0.9, 1)], "s double, y int"), "s", "y").first()
    assert (eer.threshold, eer.eer) == (0.801, 0.25)  # the first threshold at which misses outnumber false alarms


def test_funnel_skips_missing_inputs(spark):
    from siftspark.plans.config import Config
    from siftspark.plans.screening import Screening

    library = spark.createDataFrame([(0, "CC", "a"), (1, "C.C", "b"), (2, "CO", "a"), (3, "CN", "c")], "row_id int, smiles string, name string")
    scores = spark.createDataFrame([("a", "-7.5"), ("c", "N/A"), ("b", "-9")], "name string, dock_score string")
    state = Screening(Config(), library, dock_scores=scores)
    assert [r.name for r in state.results().collect()] == ["a"]
    assert rows(state.prepared().library.select("row_id")) == [(0,), (3,)]
