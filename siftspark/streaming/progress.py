"""Following a run's log: module changes, progress, running sums and the last lines.

Each view of (seq, ts, level, message) is an aggregate and a way to show it. On a table it is applied once;
follow() keeps the aggregate as the state of a stream and shows it after every micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siftspark.functions.scalars import batch_size_of, percent_of, strip_ansi
from siftspark.operators.ordering import with_previous

LOG = "seq bigint, ts timestamp, level string, message string"
MODULES = ("library", "receptor", "physchem", "admet", "druglikeness", "prepare_ligand", "docking", "results")


def module_of(modules: tuple[str, ...] = MODULES) -> Column:
    """The module that a message announces as ``MODULE <key>:``; null for other messages."""
    found = F.regexp_extract("message", "MODULE ([a-z_]+):", 1)
    return F.when(found.isin(*modules), found)


@dataclass(frozen=True)
class View:
    """What is kept of a log (an aggregate that Spark can hold as the state of a stream), and how it is shown."""

    state: Callable[[DataFrame], DataFrame]
    show: Callable[[DataFrame], DataFrame]

    def __call__(self, log: DataFrame) -> DataFrame:
        return self.show(self.state(log))


def transition_view(modules: tuple[str, ...] = MODULES) -> View:
    def state(log: DataFrame) -> DataFrame:
        return log.withColumn("module", module_of(modules)).filter("module IS NOT NULL").groupBy("module").agg(F.min("seq").alias("first_seq"), F.max("seq").alias("_last"))

    def show(began: DataFrame) -> DataFrame:
        latest = F.broadcast(began.agg(F.max_by("module", "_last").alias("_current")))
        place = F.array_position(F.array(*map(F.lit, modules)), F.col("module")) - 1
        return began.crossJoin(latest).select("module", "first_seq", (F.col("module") != F.col("_current")).alias("completed"), F.floor(place * 100 / (len(modules) - 1)).cast("int").alias("progress"))

    return View(state, show)


def percent_view() -> View:
    def state(log: DataFrame) -> DataFrame:
        return log.withColumn("_p", percent_of(strip_ansi(F.col("message")))).filter("_p IS NOT NULL").groupBy().agg(F.max_by("_p", "seq").alias("percent"))

    return View(state, lambda kept: kept)


def batch_view(total: int) -> View:
    def state(log: DataFrame) -> DataFrame:
        return log.groupBy().agg(F.coalesce(F.sum(batch_size_of(F.col("message"))), F.lit(0)).alias("done"))

    return View(state, lambda kept: kept.withColumn("percent", F.least(F.lit(100), F.floor(F.col("done") * 100 / max(total, 1))).cast("int")))


def transitions(log: DataFrame, modules: tuple[str, ...] = MODULES) -> DataFrame:
    """(module, first_seq, completed, progress): when each module began, whether a later one did, and
    the per cent of the modules that it stands for."""
    return transition_view(modules)(log)


def latest_percent(log: DataFrame) -> DataFrame:
    """One row: the last percentage of a progress line."""
    return percent_view()(log)


def batches_done(log: DataFrame, total: int) -> DataFrame:
    """One row: the sum of the batch sizes, and its share of the total, at most 100."""
    return batch_view(total)(log)


def log_tail(log: DataFrame, n: int = 1000) -> DataFrame:
    """The last n lines."""
    return log.orderBy(F.desc("seq")).limit(n)


def progress_lines(log: DataFrame) -> DataFrame:
    """Progress lines that differ from the one before, and warnings and errors."""
    line = strip_ansi(F.col("message"))
    marked = log.withColumn("message", line).filter(percent_of(F.col("message")).isNotNull() | F.lower("message").rlike("error|warning"))
    return with_previous(marked, ["seq"], "message", "_b").filter(~F.col("_b").eqNullSafe(F.col("message"))).drop("_b")


def read_log(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """A stream of JSON log lines as they are added to a folder."""
    return spark.readStream.schema(LOG).option("maxFilesPerTrigger", files_per_batch).json(folder)


Sink = Callable[[str, DataFrame, int], None]


def follow(log: DataFrame, views: dict[str, View], sink: Sink, checkpoint: str, **trigger: object) -> list[StreamingQuery]:
    """Send each view of the whole log so far to a sink (name, rows, batch number), again after every micro-batch.

    Each view is a stream of its own, whose aggregate is kept as Spark's state below ``checkpoint``.
    """

    def started(name: str, view: View) -> StreamingQuery:
        writer = view.state(log).writeStream.outputMode("complete").foreachBatch(lambda kept, number: sink(name, view.show(kept), number))
        return writer.option("checkpointLocation", f"{checkpoint}/{name}").trigger(**(trigger or {"availableNow": True})).start()

    return [started(name, view) for name, view in views.items()]


def follow_tail(log: DataFrame, n: int, folder: str, sink: Sink, checkpoint: str, **trigger: object) -> StreamingQuery:
    """Send the last n lines so far to a sink after every micro-batch; they are kept in the folder from batch to batch."""
    spark = log.sparkSession
    schema = log.schema

    def each(batch: DataFrame, number: int) -> None:
        before = spark.read.schema(schema).parquet(f"{folder}/batch={number - 1}") if number else spark.createDataFrame([], schema)
        log_tail(batch.unionByName(before), n).write.mode("overwrite").parquet(f"{folder}/batch={number}")
        sink("tail", spark.read.schema(schema).parquet(f"{folder}/batch={number}"), number)

    return log.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def running_sum(log: DataFrame, watermark: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Batch sizes by window of event time; late lines within the watermark still count."""
    return log.withWatermark("ts", watermark).groupBy(F.window("ts", window)).agg(F.sum(batch_size_of(F.col("message"))).alias("done"))


# The rest is not part of following a run: windowed counts of events, as streams or batches.


def tumbling_counts(events: DataFrame, width: str, watermark: str = "10 minutes") -> DataFrame:
    return _watermarked(events, watermark).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "event_type", "n")


def sliding_counts(events: DataFrame, width: str, slide: str, watermark: str = "10 minutes") -> DataFrame:
    return _watermarked(events, watermark).groupBy(F.window("ts", width, slide).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "event_type", "n")


def session_counts(events: DataFrame, gap: str, watermark: str = "10 minutes") -> DataFrame:
    return _watermarked(events, watermark).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select(F.col("w.start").alias("session_start"), "user_id", "n")


def _watermarked(events: DataFrame, watermark: str) -> DataFrame:
    return events.withWatermark("ts", watermark) if events.isStreaming else events
