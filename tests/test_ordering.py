"""Orders, running sums and pairs over ranges, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from siftspark.operators import evaluation, ordering, similarity


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(7)
    values = [(i, rng.choice([None, *range(9)])) for i in range(500)]
    rng.shuffle(values)
    return spark.createDataFrame(values, "i int, v int").repartition(7)


def test_numbers_and_sums(series):
    rows = sorted((r.i, r.v) for r in series.collect())
    assert sorted((r.n, r.i) for r in ordering.numbered(series, [F.desc("i")], "n", 5).collect()) == [(5 + k, 499 - k) for k in range(500)]
    total, best, before = 0, None, None
    sums = {r.i: r.v_sum for r in ordering.running_sums(series, ["i"], ["v"]).collect()}
    most = {r.i: r.m for r in ordering.running_extreme(series, ["i"], "v", "m").collect()}
    last = {r.i: r.b for r in ordering.with_previous(series, ["i"], "v", "b").collect()}
    for i, v in rows:
        total += v or 0
        best = v if best is None else best if v is None else max(best, v)
        assert (sums[i], most[i], last[i]) == (total, best, before)
        before = v
    assert sorted(r.i for r in ordering.first_rows(series, ["i"], 123).collect()) == list(range(123))
    assert ordering.numbered(series.limit(0), ["i"]).count() == 0


def test_series_in_ranges_equal_windows(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(i, rng.randrange(50)) for i in range(300)], "i int, v int").repartition(5)
    one = {r.i: (r.best, r.waited) for r in evaluation.best_so_far(df, "i", "v").collect()}
    many = {r.i: (r.best, r.waited) for r in evaluation.best_so_far(df.withColumn("g", F.lit(1)), "i", "v", by=["g"]).collect()}
    assert one == many
    smooth = {r.i: r.smooth for r in evaluation.smoothed(df, "i", "v", 4).collect()}
    assert smooth == {r.i: r.smooth for r in evaluation.smoothed(df.withColumn("g", F.lit(1)), "i", "v", 4, ["g"]).collect()}


@pytest.mark.parametrize("t", [0.4, 0.75, 1.0])
def test_dense_pairs_equal_brute_force(spark, t):
    rng = random.Random(2)
    prints = [[rng.getrandbits(63), rng.getrandbits(20)] for _ in range(60)]
    prints += [[p[0] ^ 1 << rng.randrange(60), p[1]] for p in prints[:30]] + [[0, 0], prints[0]]
    df = spark.createDataFrame(list(enumerate(prints)), "id int, fp array<bigint>")
    bits = [p[0] | p[1] << 64 for p in prints]
    sim = lambda x, y: (x & y).bit_count() / (x | y).bit_count() if x | y else 0.0
    want = sorted((i, j) for j in range(len(bits)) for i in range(j) if sim(bits[i], bits[j]) >= t)
    assert sorted((r.a, r.b) for r in similarity.dense_pairs(df, t, block=10).collect()) == want
    between = sorted((r.a, r.b) for r in similarity.dense_pairs(df.filter("id < 40"), t, df.filter("id >= 40"), block=10).collect())
    assert between == [(i, j) for i, j in want if i < 40 <= j]
    assert similarity.dense_pairs(df.limit(0), t).count() == 0
