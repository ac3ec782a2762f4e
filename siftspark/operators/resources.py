"""Choosing compute nodes and GPUs from status tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.operators.ordering import numbered


def slots(nodes: DataFrame, per_power: float = 0.6) -> DataFrame:
    """Power of each node (cpus x 1.5 - load, not below 0, times its factor) and its share of the slots wanted.

    ``nodes``: node, ncpu, load, factor, wanted; a status table has a row per machine.
    """
    power = F.greatest(F.col("ncpu") * 1.5 - F.col("load"), F.lit(0.0)) * F.col("factor")
    rows = nodes.withColumn("power", power)
    total = F.broadcast(rows.agg(F.sum("power").alias("_total")))
    share = F.try_divide(F.col("wanted") * F.col("power"), F.col("_total") * per_power)
    return rows.crossJoin(total).withColumn("slots", F.bround(F.coalesce(share, F.lit(0.0))).cast("int")).drop("_total")


def waves(jobs: DataFrame, order: str, workers: int, per_worker: int = 1) -> DataFrame:
    """Add wave, worker: jobs in order, dealt to the workers in turn, ``per_worker`` at once."""
    at_once = workers * per_worker
    placed = numbered(jobs, [order], "_place")
    return placed.withColumn("wave", F.floor(F.col("_place") / at_once).cast("int")).withColumn("worker", F.pmod("_place", F.lit(workers)).cast("int")).drop("_place")


def waiting(jobs: DataFrame, order: str, done: DataFrame, running: DataFrame, slots: int, key: str = "job") -> DataFrame:
    """The jobs to start now: in order, those neither done nor running, as many as slots are free. ``running`` is a row per slot in use."""
    free = max(0, slots - running.count())
    return jobs.join(done.select(key), key, "left_anti").join(F.broadcast(running.select(key)), key, "left_anti").orderBy(order).limit(free)


def parse_gpus(lines: DataFrame) -> DataFrame:
    """(host, gpu_id, used_mb, util) from status lines ``host: index, 1234 MiB, 56 %``; other lines are left out."""
    part = lambda k: F.regexp_extract("value", r"^\s*(\S+?):\s*(\d+)\s*,\s*(\d+)\s*MiB\s*,\s*(\d+)\s*%", k)
    return lines.filter(part(1) != "").select(part(1).alias("host"), part(2).alias("gpu_id"), part(3).cast("int").alias("used_mb"), part(4).cast("int").alias("util"))


def parse_nodes(lines: DataFrame) -> DataFrame:
    """(node, ncpu, load) from status lines ``node ncpu=16 load=3.5``; a load that is no number counts as 0."""
    part = lambda p: F.regexp_extract("value", p, 1)
    rows = lines.select(part(r"^\s*(\S+)\s").alias("node"), part(r"ncpu=(\d+)").alias("_n"), part(r"load=(\S+)").alias("_l"))
    return rows.filter("_n != ''").select("node", F.col("_n").cast("int").alias("ncpu"), F.coalesce(F.expr("try_cast(_l AS DOUBLE)"), F.lit(0.0)).alias("load"))


def best_node(nodes: DataFrame) -> DataFrame:
    return nodes.orderBy(F.desc("power"), "node").limit(1)


def free_gpus(gpus: DataFrame, n: int, least_free_mb: int = 10_000, most_busy: int = 70, memory_mb: int = 24_576) -> DataFrame:
    """The n least busy GPUs with enough free memory, the later host first."""
    free = gpus.filter((memory_mb - F.col("used_mb") > least_free_mb) & (F.col("util") < most_busy))
    return free.orderBy(F.desc("host"), "util", "gpu_id").limit(n)
