"""Exact top-k search, quantiles, ranks and numbers within groups against brute force."""

import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftspark.operators import ordering, quantiles, sampling, similarity, topk


def sim(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def brute(queries, library, k):
    out = {}
    for q, x in queries.items():
        found = sorted((-sim(x, y), i) for i, y in library.items() if x & y)[:k]
        out[q] = [(i, -s) for s, i in found]
    return out


def prints(n, width=1024, on=45, families=40, seed=1):
    """Sparse sets in families, as circular prints are: a core, common bits, and bits of their own."""
    r = random.Random(seed)
    cores = [r.sample(range(40, width), on) for _ in range(families)]
    return {i: {b for b in cores[i % families] if r.random() < 0.8} | set(r.sample(range(40), 6)) | set(r.sample(range(width), r.randrange(8))) for i in range(n)}


def frame(spark, sets_):
    return spark.createDataFrame([(i, sorted(x)) for i, x in sets_.items()], "id bigint, bits array<int>")


def places(rows, query="query", other="id"):
    out = {}
    for r in sorted(rows, key=lambda r: (r[query], r["place"])):
        out.setdefault(r[query], []).append((r[other], round(r["sim"], 12)))
        assert r["place"] == len(out[r[query]])
    return out


def test_top_similar_sets_compare_few_pairs(spark):
    library = prints(1500)
    queries = {i: x for i, x in library.items() if i % 20 == 0}
    seen = []
    got = places(topk.top_similar(frame(spark, queries), frame(spark, library), 10, seen=seen).collect())
    want = brute(queries, library, 10)
    assert got.keys() == want.keys() and all([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in want)
    assert all(math.isclose(a, b, abs_tol=1e-11) for q in want for (_, a), (_, b) in zip(got[q], want[q]))
    assert sum(seen) < len(queries) * len(library) / 5, seen


@pytest.mark.parametrize("block", [3, 20_000])
def test_top_similar_on_odd_sets(spark, block):
    library = prints(120, width=80, on=10, families=5) | {1000: set(), 1001: {5}, 1002: {5}, 1003: {5, 6}, 1004: set(range(80)), 1005: {79}}
    queries = {1: {5}, 2: set(), 3: {999}, 4: {5, 999, 998}, 5: set(range(80)), 6: library[0], 7: {5, 6, 7, 79}}
    got = places(topk.top_similar(frame(spark, queries), frame(spark, library), 4, block=block).collect())
    want = {q: x for q, x in brute(queries, library, 4).items() if x}
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}
    assert topk.top_similar(frame(spark, queries), frame(spark, library).limit(0), 4).count() == 0
    assert topk.top_similar(frame(spark, queries).limit(0), frame(spark, library), 4).count() == 0


@pytest.mark.parametrize("most_bytes", [300, 32 << 20])
def test_top_shared_is_exact_and_shuffles_no_postings(spark, most_bytes):
    library = prints(300, width=300) | {1000: set(), 1001: {5}, 1002: {5}, 1003: {5, 2**60 + 6}, 1004: set(range(300)), 1005: {-79}}
    queries = {i: x for i, x in library.items() if i % 20 == 0} | {1: {5}, 2: set(), 3: {999}, 4: {5, 999, -79}, 7: {5, 2**60 + 6}}
    sets_ = lambda x: spark.createDataFrame([(i, sorted(b) * 2) for i, b in x.items()], "id bigint, bits array<bigint>")
    # One id twice, halves of a set each.
    whole = sorted(library.pop(40))
    both = sets_(library).union(sets_({40: set(whole[::2])})).union(sets_({40: set(whole[1::2])}))
    library[40] = set(whole)
    got = places(topk.top_shared(sets_(queries), both, 4, most_bytes=most_bytes).collect())
    want = {q: x for q, x in brute(queries, library, 4).items() if x}
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}
    assert all(math.isclose(a, b, abs_tol=1e-11) for q in want for (_, a), (_, b) in zip(got[q], want[q]))
    assert topk.top_shared(sets_(queries), both.limit(0), 4).count() == 0 == topk.top_shared(sets_(queries).limit(0), both, 4).count()
    # Of the library's bits only those go on that a query may have, so what is written does not grow with the others.
    far = sets_({i: set(range(1 << 20, (1 << 20) + 500)) | {i} for i in range(50)})
    kept = topk._asked_only(topk._distinct_sets(far), topk._distinct_sets(sets_({1: {3, 4}})), 2)
    assert sum(len(r["bits"]) for r in kept.collect()) < 50 * 501 / 4


def test_postings_count_in_pieces():
    import pyarrow as pa

    library = prints(200, width=100)
    rows = pa.table({"id": pa.array([1, 2, 3]), "bits": pa.array([sorted(library[i]) for i in (1, 2, 3)], pa.list_(pa.int64()))})
    size = np.array([len(x) for x in library.values()])
    lists = pa.array([sorted(x) for x in library.values()], pa.list_(pa.int64()))
    found = []
    for cells in (7, 8_000_000):
        postings = topk.Postings(rows, 5)
        postings.meet(np.arange(200), size, lists, cells)
        found.append(postings.found().to_pylist())
    assert found[0] == found[1] and [r["id"] for r in found[0]] == [i for q in (1, 2, 3) for i, _ in brute({q: library[q]}, library, 5)[q]]


def packed(spark, sets_, words):
    rows = [(i, [int(np.uint64(sum(1 << (b - 64 * w) for b in x if b // 64 == w)).view(np.int64)) for w in range(words)]) for i, x in sets_.items()]
    return spark.createDataFrame(rows, "id bigint, fp array<bigint>")


def all_pairs(left, right, k):
    return {i: [(j, round(-s, 12)) for s, j in sorted((-sim(x, y), j) for j, y in right.items())[:k]] for i, x in left.items()}


@pytest.mark.parametrize("most_bytes", [32 << 20, 1200])
def test_nearest_prints_are_those_of_all_pairs(spark, most_bytes):
    r = random.Random(7)
    library = {i: set(r.sample(range(128), r.choice([0, 1, 3, 20, 60, 64, 100]))) for i in range(300)}
    listed = {i: x for i, x in library.items() if i % 10 == 0}
    near = topk.nearest_prints(packed(spark, library, 2), packed(spark, listed, 2), 3, most_bytes)
    assert places(near.collect(), "target", "query") == all_pairs(library, listed, 3)
    top = topk.top_prints(packed(spark, library, 2).repartition(5), packed(spark, listed, 2), 5, most_bytes)
    assert places(top.collect(), "query", "target") == all_pairs(listed, library, 5)


def test_sizes_that_cannot_win_are_skipped():
    r = random.Random(3)
    rows = [np.packbits(np.isin(np.arange(1024), r.sample(range(1024), n))).view(np.uint64) for n in [10, 30, 90, 270] * 100]
    block = topk.Prints(np.array(rows), np.arange(len(rows)))
    place, sims = block.best(np.array(rows), 1)
    assert (sims[:, 0] == 1).all() and (block.ids[place[:, 0]] == np.arange(400)).all()
    assert block.compared <= 400 * 100


def test_rows_without_queries(spark):
    some, none = packed(spark, {1: {3}, 2: set()}, 1), packed(spark, {1: {3}}, 1).limit(0)
    assert topk.nearest_prints(some, none).count() == 0 and topk.top_prints(some, none, 2).count() == 0
    assert topk.nearest_prints(none, some).count() == 0 and topk.top_prints(none, some, 2).count() == 0


# --- quantiles ----------------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.lists(st.floats(allow_nan=True), min_size=1))
def test_keys_order_as_doubles_do(values):
    x = np.array(values)
    keys = quantiles.keys_of(x)
    back = quantiles.values_of(np.sort(keys))
    np.testing.assert_array_equal(back, np.sort(x))


@pytest.mark.parametrize("few", [0, 3, 50_000])
def test_quantiles_are_exact(spark, few):
    r = random.Random(few)
    columns = {
        "even": [r.gauss(0, 1) for _ in range(1000)],
        "ties": [float(r.randrange(5)) for _ in range(999)] + [None],
        "same": [2.5] * 700 + [None] * 300,
        "wide": [r.choice([-1, 1]) * 10.0 ** r.uniform(-300, 300) for _ in range(998)] + [math.inf, -math.inf],
        "zeros": [r.choice([0.0, -0.0]) for _ in range(1000)],
        "none": [None] * 1000,
        "one": [None] * 999 + [7.0],
    }
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} double" for c in columns)).repartition(7)
    places_ = {c: [0, 1, 499, 500, 699] for c in columns}
    got = quantiles.order_statistics(df, places_, few)
    for c, values in columns.items():
        ordered = sorted(v for v in values if v is not None)
        assert {p: v for (k, p), v in got.items() if k == c} == {p: ordered[p] for p in places_[c] if p < len(ordered)}
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = quantiles.quantiles(df, {c: shares for c in columns if c != "wide"})
    for (c, q), v in got.items():
        ordered = [x for x in columns[c] if x is not None]
        assert v is None if not ordered else v == pytest.approx(np.quantile(ordered, q), rel=1e-12)
    assert quantiles.medians(df.limit(0), ["even"]) == {"even": None}
    assert quantiles.medians(spark.createDataFrame([(1,), (4,)], "i int"), ["i"]) == {"i": 2.5}


# --- ranks --------------------------------------------------------------------------------------


@pytest.mark.parametrize("descending", [True, False])
def test_ranks_across_ranges(spark, descending):
    r = random.Random(9)
    values = [r.choice([1.0, 1.0, 1.0, None, r.random(), 0.5]) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    plan = ordering.ranked(df, "v", descending=descending)
    key = lambda v: (v is None, -v if descending and v is not None else v or 0)
    for x in plan.collect():
        assert x["rank"] == 1 + sum(key(v) < key(x["v"]) for v in values)
    assert ordering.ranked(df.limit(0), "v").count() == 0
    assert {x["rank"] for x in ordering.ranked(df.filter("v = 1"), "v").collect()} == {1}


def test_numbers_within_groups_that_span_ranges(spark):
    r = random.Random(1)
    rows = [(r.choice(["a"] * 8 + ["b", None, ""]), r.randrange(50), i) for i in range(700)]
    df = spark.createDataFrame(rows, "g string, x int, i int")
    got = ordering.numbered_within(df, ["g"], [F.desc("x"), F.col("i")]).collect()
    want = {}
    for g in {g for g, *_ in rows}:
        for k, (_, x, i) in enumerate(sorted((t for t in rows if t[0] == g), key=lambda t: (-t[1], t[2])), 1):
            want[i] = k
    assert {x["i"]: x["place"] for x in got} == want
    assert ordering.numbered_within(df.limit(0), ["g"], ["x"]).count() == 0


def test_no_window_of_ranks_sees_all_rows(spark):
    df = spark.range(1000).select("id", F.rand(1).alias("v"))
    plan = ordering.ranked(df, "v")._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan.split("== Physical Plan ==")[1]


def test_similarity_of_many_queries(spark):
    df = spark.createDataFrame([(i, [i * 2654435761 % 2**40]) for i in range(50)], "id bigint, fp array<bigint>")
    want = sorted(map(tuple, similarity.similarity_matrix(df, df).collect()))
    assert len(want) == 2500 and sorted(map(tuple, similarity.similarity_matrix(df, df, most_bytes=300).collect())) == want
    ranked = similarity.ranked_matches(similarity.similarity_matrix(df, df)).collect()
    assert sorted((r["query"], r["place"]) for r in ranked) == [(q, p) for q in range(50) for p in range(1, 51)]


@pytest.mark.parametrize("words", [1, 3])
def test_ranks_of_prints_without_a_sort_of_pairs(spark, monkeypatch, words):
    r = random.Random(words)
    rows = [(i * 8 % 301 - 50, [sum(1 << b for b in range(63) if r.random() < 0.3) for _ in range(words)]) for i in range(301)]
    rows = [(i, f if i % 9 else [0] * words) for i, f in rows] + [(500, None), (520, None), (-60, rows[5][1])]
    df = spark.createDataFrame(rows, "id bigint, fp array<bigint>")
    prints = dict(rows)

    def sim(a, b):
        if a is None or b is None:
            return None
        shared, either = (sum(f(x, y).bit_count() for x, y in zip(a, b, strict=True)) for f in (int.__and__, int.__or__))
        return shared / either if either else 0.0

    want = []
    for q in (i for i in prints if i % 20 == 0):
        order = sorted(((sim(prints[i], prints[q]), i) for i in prints), key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
        want += [(i, q, s, k + 1) for k, (s, i) in enumerate(order)]
    monkeypatch.setattr(similarity, "numbered_within", None)  # places by a sort of all pairs
    for block, query_rows in ((16_384, 512), (40, 3)):
        got = topk.ranked_prints(df, df.filter("id % 20 = 0"), block, query_rows)
        assert sorted(map(tuple, got.collect()), key=lambda x: x[1::2]) == sorted(want, key=lambda x: x[1::2])


@pytest.mark.parametrize("words", [1, 3])
def test_matrix_of_prints_compares_numbers(spark, words):
    df = spark.createDataFrame([(1, [7] * words), (2, [0] * words), (3, None), (4, [1] * words), (5, [-1] * words)], "id bigint, fp array<bigint>")
    matrix = similarity.similarity_matrix(df, df)
    pair = df.select(F.col("id").alias("a"), F.col("fp").alias("x")).crossJoin(df.select(F.col("id").alias("b"), F.col("fp").alias("y")))
    want = pair.select("a", "b", F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), similarity.tanimoto(F.col("x"), F.col("y")))).collect()
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, matrix.collect()), key=key) == sorted(map(tuple, want), key=key)
    joined = matrix._jdf.queryExecution().executedPlan().toString()
    assert "zip_with" not in joined  # no array is walked for a pair


@pytest.mark.parametrize("words", [1, 3])
def test_mean_similarity_without_pairs(spark, words):
    r = random.Random(words)
    sets_ = {i: set(r.sample(range(64 * words), r.randrange(64 * words))) for i in range(90)} | {90: set(), 91: {0}, 92: set(range(16)), 93: set(range(64 * words))}
    df = packed(spark, sets_, words)
    queries = df.filter("id % 3 = 0")
    want = {r["target"]: r["mean_sim"] for r in similarity.mean_similarity_filter(similarity.similarity_matrix(df, queries), 0.2).collect()}
    for most_bytes in (300, 32 << 20):
        got = similarity.mean_similarity_prints(df, queries, 0.2, most_bytes)
        assert {r["target"]: r["mean_sim"] for r in got.collect()} == want and 0 < len(want) < len(sets_)
    plan = got._jdf.queryExecution().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert similarity.mean_similarity_prints(df, queries.limit(0), 0.2).count() == 0 == similarity.mean_similarity_prints(df.limit(0), queries, 0.2).count()


def written_bytes(df, folder):
    """Bytes a row that the columns take in the files of a result."""
    df.write.parquet(str(folder))
    files = [pq.ParquetFile(f).metadata for f in folder.glob("*.parquet")]
    groups = [m.row_group(g) for m in files for g in range(m.num_row_groups)]
    n = sum(g.num_rows for g in groups)
    return n, {c: sum(g.column(i).total_compressed_size for g in groups) / n for i, c in enumerate(df.columns)}


def test_ranks_are_written_in_few_bytes(spark, tmp_path):
    r = np.random.default_rng(1)
    prints = lambda n: spark.createDataFrame([(i, [int(x)]) for i, x in enumerate(r.integers(-(2**63), 2**63 - 1, n))], "id bigint, fp array<bigint>")
    n, size = written_bytes(topk.ranked_prints(prints(20_000), prints(100)), tmp_path / "ranks")
    assert n == 2_000_000 and size["target"] < 2.2 and sum(size.values()) < 4.5


def test_matrix_is_written_in_few_bytes(spark, tmp_path):
    r = np.random.default_rng(2)
    prints = lambda n: spark.createDataFrame([(i, [int(x)]) for i, x in enumerate(r.integers(-(2**63), 2**63 - 1, n))], "id bigint, fp array<bigint>")
    n, size = written_bytes(similarity.similarity_matrix(prints(300), prints(25_000)), tmp_path / "matrix")
    assert n == 7_500_000 and size["query"] < 0.3 and sum(size.values()) < 1.5


# --- draws --------------------------------------------------------------------------------------


def test_weighted_draws_follow_the_weights(spark):
    n, drawn = 400, 60
    rows = [(i, float(1 + i % 4)) for i in range(n)] + [(1000, 0.0), (1001, None), (1002, -1.0)]
    df = spark.createDataFrame(rows, "id int, w double").repartition(3)
    hits = np.zeros(5)
    for seed in range(12):
        got = [r["id"] for r in sampling.weighted_draw(df, "w", "id", drawn, seed).collect()]
        assert len(set(got)) == len(got) == drawn and max(got) < n
        for i in got:
            hits[1 + i % 4] += 1
    # Of weights 1 to 4 in equal numbers, the chance of inclusion is near the weight's share as few are drawn.
    r, keys = np.random.default_rng(1), np.zeros(5)
    for _ in range(400):
        order = np.argsort(-np.log(r.random(n)) / (1 + np.arange(n) % 4))[:drawn]
        np.add.at(keys, 1 + order % 4, 1)
    assert np.abs(hits / hits.sum() - keys / keys.sum()).max() < 0.05
    assert sampling.weighted_draw(df, "w", "id", 0, 1).count() == 0
    assert sampling.weighted_draw(df, "w", "id", 10_000, 1).count() == n
    twice = df.unionByName(df)
    assert sampling.weighted_draw(twice, "w", "id", 31, 1).count() == 31


def test_hits_of_the_last_iteration():
    assert [sampling.last_hits(n, 0.01) for n in (50, 5000, 100_000)] == [0, 50, 1000]
    assert [sampling.last_hits(n) for n in (50, 5000)] == [50, 100]
