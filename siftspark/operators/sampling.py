"""Deterministic sampling, splits and allocation. Random order is the order of a hash of seed and id."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftspark.operators.ordering import first_rows, numbered
from siftspark.operators.quantiles import order_statistics
from siftspark.session import checkpointed


#: Hashes in place of random numbers have so many bits, which a double holds exactly.
HASH_BITS = 52


def shuffled(seed: int, *key: str) -> Column:
    """A whole number below 2 ** HASH_BITS to order by in place of a random permutation: the first digits of the MD5 of
    ``seed:key``, so that any other engine can draw the same rows. A null key counts as empty."""
    text = F.concat(F.lit(str(seed)), *[x for k in key for x in (F.lit(":"), F.coalesce(F.col(k).cast("string"), F.lit("")))])
    return F.conv(F.left(F.md5(text), F.lit(HASH_BITS // 4)), 16, 10).cast("bigint")


def shard_counts(df: DataFrame, shard: str) -> DataFrame:
    return df.groupBy(shard).agg(F.count("*").alias("n_rows"))


def chunks(df: DataFrame, order: str, n_chunks: int) -> DataFrame:
    """Add chunk: contiguous parts of ceil(n / k) rows in an order, from 0."""
    placed = numbered(df, [order], "_place")
    return placed.withColumn("chunk", chunk_number(df.count(), n_chunks, F.col("_place") + 1)).drop("_place")


def allocate(counts: DataFrame, total_sample: int) -> DataFrame:
    """Sample size of each shard, in proportion to its rows, rounded down; the total is one row."""
    total = F.broadcast(counts.agg(F.sum("n_rows").alias("_total")))
    return counts.crossJoin(total).withColumn("n_sample", F.floor(F.lit(float(total_sample)) / F.col("_total") * F.col("n_rows")).cast("bigint")).drop("_total")


def _unit(seed: int, key: str) -> Column:
    return shuffled(seed, key) / F.lit(float(2**HASH_BITS))


def stratified_split(df: DataFrame, shard: str, key: str, sizes: DataFrame, seed: int) -> DataFrame:
    """Rows of each shard in random order, the first n_train for training, then n_valid, then n_test; the rest goes.

    ``sizes``: (shard, n_train, n_valid, n_test), a row per shard. A shard is cut by the hash that is expected to
    hold twice its sample and more, so that only those rows are sorted. Where that falls short, as where a few keys are
    repeated very often, the whole shard is taken; a shard with fewer rows than wanted gives all it has.
    """
    wanted = F.col("n_train") + F.col("n_valid") + F.col("n_test")
    counts = shard_counts(df, shard).join(sizes, shard).withColumn("_share", F.least(F.lit(1.0), (2 * wanted + 100) / F.col("n_rows")))
    hashed = df.withColumn("_u", _unit(seed, key))
    near = hashed.join(counts, shard).groupBy(shard).agg(F.count_if(F.col("_u") < F.col("_share")).alias("_near"))
    cut = counts.join(near, shard).withColumn("_share", F.when(F.col("_near") < wanted, 1.0).otherwise(F.col("_share"))).drop("_near", "n_rows")
    place = F.row_number().over(Window.partitionBy(shard).orderBy("_u", key))
    placed = hashed.join(cut, shard).filter(F.col("_u") < F.col("_share")).withColumn("_place", place)
    split = (
        F.when(F.col("_place") <= F.col("n_train"), "train")
        .when(F.col("_place") <= F.col("n_train") + F.col("n_valid"), "valid")
        .when(F.col("_place") <= wanted, "test")
    )
    return placed.withColumn("split", split).filter(F.col("split").isNotNull()).select(*df.columns, "split")


def split_ratio(total: int, train_ratio: float | None) -> tuple[int, int, int]:
    """Sizes train : valid : test as r : 1 : 1 in the first iteration, else thirds."""
    part = total / (2 + (train_ratio if train_ratio is not None else 1))
    return int(part * (train_ratio if train_ratio is not None else 1)), int(part), int(part)


def chunk_number(n_rows: int, n_chunks: int, row_number: Column) -> Column:
    """Contiguous chunks of ceil(n / k) rows; row_number counts from 1."""
    return F.floor((row_number - 1) / F.lit(max(1, ceil(n_rows / n_chunks)))).cast("int")


def _turns(loads: list[int], size: int, n: int) -> list[tuple[int, int, list[int]]]:
    """(first, groups, folds in turn) when n groups of one size go to the lightest fold, one after the other. Changes the loads.

    Folds that are lighter than the lightest plus one group take one group each, in order of load, and so on until they
    reach the next fold; so there are few stretches, however many groups.
    """
    out, done = [], 0
    while done < n:
        order = sorted(range(len(loads)), key=lambda f: (loads[f], f))
        low = loads[order[0]]
        turn = [f for f in order if loads[f] < low + size]
        above = [loads[f] for f in order if loads[f] >= low + size]
        rounds = max(1, -(-(above[0] - low - size) // size)) if above else n
        take = min(n - done, rounds * len(turn))
        out.append((done, take, turn))
        for k, f in enumerate(turn):
            loads[f] += size * (take // len(turn) + (k < take % len(turn)))
        done += take
    return out


def group_folds(df: DataFrame, group: str, k: int) -> DataFrame:
    """(group, n, fold): the largest group goes to the lightest fold, in turn; groups of one size in order.

    Only the number of groups of each size comes to the driver: there are fewer sizes than the root of twice the rows.
    """
    counts = df.groupBy(group).agg(F.count("*").alias("n"))
    placed = checkpointed(numbered(counts, [F.desc("n"), F.col(group)], "_place"))
    loads, rows, before = [0] * k, [], 0
    for r in placed.groupBy("n").agg(F.count("*").alias("groups")).orderBy(F.desc("n")).collect():
        rows += [(r["n"], before, before + first, take, turn) for first, take, turn in _turns(loads, r["n"], r["groups"])]
        before += r["groups"]
    turns = df.sparkSession.createDataFrame(rows, "_n bigint, _begin bigint, _first bigint, _take bigint, _turn array<int>")
    inside = (F.col("n") == F.col("_n")) & (F.col("_place") >= F.col("_first")) & (F.col("_place") < F.col("_first") + F.col("_take"))
    fold = F.get("_turn", F.pmod(F.col("_place") - F.col("_first"), F.size("_turn")).cast("int"))
    return placed.join(F.broadcast(turns), inside).select(group, "n", fold.alias("fold"))


def shuffled_folds(df: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    """Add fold: rows in random order, dealt to folds of equal size but for one row."""
    return numbered(df, [shuffled(seed, key), F.col(key)], "_place").withColumn("fold", F.pmod("_place", F.lit(k)).cast("int")).drop("_place")


def random_subset(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """n rows at random. Rows are cut at the hash that is expected to leave a few more, and only those are sorted."""
    total = df.count()
    if n >= total:
        return df
    near = df.filter(_unit(seed, key) < (n + 6 * n**0.5 + 100) / total)
    near = near if near.count() >= n else df
    return first_rows(near, [_unit(seed, key), F.col(key)], n)


def _two_classes(df: DataFrame, label: str) -> tuple[object, object, int, int] | None:
    """The smaller and the larger class, and their sizes; of equals the smaller label counts as smaller."""
    n = {r[0]: r[1] for r in df.groupBy(label).agg(F.count("*")).collect()}
    if len(n) != 2:
        return None
    small, large = sorted(n, key=lambda k: (n[k], str(k)))
    return small, large, n[small], n[large]


def rebalance(df: DataFrame, label: str, key: str, seed: int) -> DataFrame:
    """Repeat the smaller class until both have equally many rows: whole repeats, and a random part once more."""
    classes = _two_classes(df, label)
    if classes is None:
        return df
    small, _, n, most = classes
    times, rest = divmod(most, n)
    rows = df.filter(F.col(label) == small)
    repeated = rows.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("_i")
    out = df.filter(F.col(label) != small).unionByName(repeated)
    return out.unionByName(random_subset(rows, rest, key, seed)) if rest else out


def downsample(df: DataFrame, label: str, key: str, seed: int) -> DataFrame:
    """A random part of the larger class, as many rows as the smaller has."""
    classes = _two_classes(df, label)
    if classes is None:
        return df
    small, large, n, _ = classes
    return df.filter(F.col(label) == small).unionByName(random_subset(df.filter(F.col(label) == large), n, key, seed))


def draws_with_replacement(df: DataFrame, label: str, key: str, factor: int, seed: int) -> DataFrame:
    """min(negatives, positives x factor) hashed draws of each class; n_draws says how often a row was drawn."""
    n = {r[0]: r[1] for r in df.groupBy(label).agg(F.count("*")).collect()}
    size = min(n.get(0, 0), n.get(1, 0) * factor)
    placed = numbered(df.filter(F.col(label).isin(0, 1)), [F.col(label), shuffled(seed, key), F.col(key)], "_i")
    classes = df.sparkSession.createDataFrame([(k, n[k], n.get(0, 0) * k) for k in (0, 1) if n.get(k)], f"_l {dict(df.dtypes)[label]}, _n bigint, _first bigint")
    draws = df.sparkSession.range(size).crossJoin(F.broadcast(classes))
    picked = draws.select((F.col("_first") + F.pmod(shuffled(seed + 1, "id", "_l"), F.col("_n"))).alias("_i")).groupBy("_i").agg(F.count("*").alias("n_draws"))
    return placed.join(picked, "_i").select(*df.columns, "n_draws")


def cyclic_mix(tables: dict[str, DataFrame], weights: dict[str, int], key: str, rounds: int, seed: int) -> DataFrame:
    """(task, place, ...): in each round so many rows of each table as its weight says, each table in a random order that starts anew at its end."""
    out = None
    for name, table in tables.items():
        n = table.count()
        wanted = weights[name] * rounds
        placed = numbered(table, [shuffled(seed, key), F.col(key)], "_i")
        draws = table.sparkSession.range(wanted if n else 0).select(F.col("id").alias("place"), F.pmod("id", F.lit(max(n, 1))).alias("_i"))
        part = draws.join(placed, "_i").drop("_i").select(F.lit(name).alias("task"), F.floor(F.col("place") / weights[name]).alias("round"), "place", *table.columns)
        out = part if out is None else out.unionByName(part)
    return out


def weighted_order(df: DataFrame, weight: str, key: str, seed: int) -> DataFrame:
    """Add draw_key: rows drawn without replacement in proportion to the weights come in order of -ln(u) / w. Rows
    without a weight above zero are never drawn."""
    u = (shuffled(seed, key) + 1) / F.lit(float(2**HASH_BITS + 1))
    return df.filter(F.col(weight) > 0).withColumn("draw_key", -F.log(u) / F.col(weight))


def weighted_draw(df: DataFrame, weight: str, key: str, n: int, seed: int) -> DataFrame:
    """n rows drawn without replacement in proportion to the weights; all that have one if they are fewer.

    The n-th least draw key is found by counting, so nothing is sorted and n may be as large as the table; only rows that tie
    there are put in order, by key.
    """
    keyed = checkpointed(weighted_order(df, weight, key, seed))
    found = order_statistics(keyed, {"draw_key": [n - 1]}) if n > 0 else {}
    if not found:
        return (keyed if n > 0 else keyed.limit(0)).select(*df.columns)
    (cut,) = found.values()
    below = keyed.filter(F.col("draw_key") < cut)
    ties = first_rows(keyed.filter(F.col("draw_key") == cut), [F.col(key)], n - below.count())
    return below.unionByName(ties).select(*df.columns)


def linear_schedule(first: int, last: int, iteration: int, iterations: int) -> int:
    """Hits to keep: from first in iteration 1 to last in the final one, by an equal share of the difference for each iteration passed."""
    passed = (iteration - 1) / max(iterations - 1, 1)
    return int(first + passed * (last - first))


def last_hits(n_scores: int, share: float | None = None) -> int:
    """Hits of the last iteration: a share of the validation scores, or 100; never more than there are."""
    return min(n_scores, 100 if share is None else int(share * n_scores))


def hit_schedules(df: DataFrame, first: str, last: str, iterations: int) -> DataFrame:
    """Rows with a first and a last number of hits, once for each iteration, with n: see :func:`linear_schedule`."""
    passed = (F.col("iteration") - 1) / F.lit(float(max(iterations - 1, 1)))
    n = F.col(first) + passed * (F.col(last) - F.col(first))
    return df.withColumn("iteration", F.explode(F.sequence(F.lit(1), F.lit(iterations)))).withColumn("n", n.cast("bigint"))
