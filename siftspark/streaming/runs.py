"""Following many runs at once: keyed state of each run's log, and jobs that no completion answers.

:func:`follow_runs` keeps a state for each run id: the modules it has announced, its last percentage, the sum of its batch
sizes. Lines that may still come again are kept by Spark, spread by run and line, so a run's state stays small however many lines
it has. Only runs with news are sent on. A run that is silent for long is
reported by a timer on event time, and takes up its work again with its next line.

:func:`overdue` joins jobs with their completions as streams. A job is answered once for each completion in time, or once
by a row without a completion when the watermark has passed its deadline; the join keeps no job longer than that.

Both survive restarts: state, timers and what has been sent on are in the stream's checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from siftspark.functions.scalars import batch_size_of, percent_of, strip_ansi
from siftspark.session import find_package
from siftspark.streaming.progress import MODULES, module_of

if TYPE_CHECKING:
    import pandas as pd

RUN_LOG = "run string, seq bigint, ts timestamp, message string"
STATUS = "run string, lines bigint, done bigint, percent int, current string, completed array<string>, last_ts timestamp, silent boolean"
#: Where Spark keeps keyed state with lists and timers.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def parsed(log: DataFrame, modules: tuple[str, ...] = MODULES) -> DataFrame:
    """(run, seq, ts, module, percent, size) of the lines; lines without a run or a time take no part."""
    line = log.filter("run IS NOT NULL AND seq IS NOT NULL AND ts IS NOT NULL").withColumn("message", strip_ansi(F.col("message")))
    return line.select("run", "seq", "ts", module_of(modules).alias("module"), percent_of(F.col("message")).alias("percent"), batch_size_of(F.col("message")).alias("size"))


def run_states(log: DataFrame, modules: tuple[str, ...] = MODULES) -> DataFrame:
    """The status of each run over a whole log; repeated lines (run, seq) count once."""
    lines = parsed(log, modules).dropDuplicates(["run", "seq"])
    sums = lines.groupBy("run").agg(F.count(F.lit(1)).alias("lines"), F.coalesce(F.sum("size"), F.lit(0)).alias("done"), F.max_by("percent", F.when(F.col("percent").isNotNull(), F.col("seq"))).alias("percent"), F.max("ts").alias("last_ts"))
    begun = lines.filter("module IS NOT NULL").groupBy("run", "module").agg(F.min("seq").alias("first"), F.max("seq").alias("last"))
    seen = begun.groupBy("run").agg(F.max_by("module", "last").alias("current"), F.array_sort(F.collect_list(F.struct("first", "module"))).alias("_all"))
    completed = F.filter(F.transform("_all", lambda m: m["module"]), lambda m: m != F.col("current"))
    empty = F.array().cast("array<string>")
    return sums.join(seen, "run", "left").select("run", "lines", "done", "percent", "current", F.coalesce(completed, empty).alias("completed"), "last_ts")


class RunTracker(StatefulProcessor):
    """The state of one run: its sums and the modules it has announced. Each line must come once."""

    def __init__(self, silence_ms: int) -> None:
        self.silence_ms = silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "lines bigint, done bigint, percent int, percent_seq bigint, last_us bigint, timer bigint")
        self.modules = handle.getListState("modules", "module string, first bigint, last bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 - Spark's names
        lines, done, percent, percent_seq, last, timer = self.sums.get() if self.sums.exists() else (0, 0, None, -1, 0, -1)
        modules = {m: [a, z] for m, a, z in self.modules.get()} if self.modules.exists() else {}
        passed = timerValues.getCurrentWatermarkInMs()
        for frame in rows:
            for seq, us, module, p, size in zip(frame["seq"], frame["us"], frame["module"], frame["percent"], frame["size"], strict=True):
                lines, last = lines + 1, max(last, int(us))
                if size == size and size is not None:
                    done += int(size)
                if p == p and p is not None and seq > percent_seq:
                    percent, percent_seq = int(p), int(seq)
                if isinstance(module, str):
                    span = modules.setdefault(module, [int(seq), int(seq)])
                    span[0], span[1] = min(span[0], int(seq)), max(span[1], int(seq))
        if modules:
            self.modules.put([(m, a, z) for m, (a, z) in modules.items()])
        if timer >= 0:
            self.handle.deleteTimer(timer)
        timer = max(last // 1000, passed) + self.silence_ms
        self.handle.registerTimer(timer)
        self.sums.update((lines, done, percent, percent_seq, last, timer))
        yield self._status(key, False)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        lines, done, percent, percent_seq, last, _ = self.sums.get()
        self.sums.update((lines, done, percent, percent_seq, last, -1))
        yield self._status(key, True)

    def _status(self, key: tuple, silent: bool) -> pd.DataFrame:
        import pandas as pd

        lines, done, percent, _, last, _ = self.sums.get()
        modules = list(self.modules.get()) if self.modules.exists() else []
        current = max(modules, key=lambda m: m[2])[0] if modules else None
        completed = [m for m, _, _ in sorted(modules, key=lambda m: m[1]) if m != current]
        row = {"run": [key[0]], "lines": [lines], "done": [done], "percent": pd.array([percent], "Int32"), "current": [current], "completed": [completed], "last_ts": [pd.Timestamp(last, unit="us")], "silent": [silent]}
        return pd.DataFrame(row)

    def close(self) -> None:
        pass


def follow_runs(log: DataFrame, late: str = "1 hour", silence_ms: int = 6 * 3600 * 1000, modules: tuple[str, ...] = MODULES) -> DataFrame:
    """A stream of STATUS rows, one for each run with news in a micro-batch, from a stream of RUN_LOG lines.

    Lines that are late by more than ``late`` are dropped; a run is silent when the watermark is ``silence_ms`` past its last line.
    """
    spark = log.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") != PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    find_package(spark)
    # A line that the watermark has passed cannot come again: Spark drops it as late.
    lines = parsed(log.withWatermark("ts", late), modules).dropDuplicatesWithinWatermark(["run", "seq"])
    rows = lines.withColumn("us", F.unix_micros("ts"))
    return rows.groupBy("run").transformWithStateInPandas(statefulProcessor=RunTracker(silence_ms), outputStructType=STATUS, outputMode="Append", timeMode="EventTime")


def write_updates(stream: DataFrame, folder: str, checkpoint: str, mode: str = "append", **trigger: object) -> StreamingQuery:
    """Write each micro-batch's rows to a part of the folder of its own; a repeated batch replaces its part."""

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    writer = stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def latest_states(spark: SparkSession, folder: str) -> DataFrame:
    """The last status of each run among the updates in a folder."""
    rows = spark.read.schema(STATUS + ", batch int").parquet(folder)
    columns = [c.split()[0] for c in STATUS.split(", ")]
    # A batch may report news and then silence of one run.
    return rows.groupBy("run").agg(F.max_by(F.struct(*columns[1:]), F.struct("batch", "lines", "silent")).alias("_s")).select("run", "_s.*")


def overdue(jobs: DataFrame, completions: DataFrame, deadline: str, late: str = "1 hour") -> DataFrame:
    """(job, submitted, finished): each completion (job, finished) of a job (job, submitted) within the deadline, and
    jobs without one, finished null, once the watermark is past their deadline. For streams and tables alike."""
    left = jobs.select("job", "submitted")
    right = completions.select(F.col("job").alias("_job"), "finished")
    if jobs.isStreaming:
        left, right = left.withWatermark("submitted", late), right.withWatermark("finished", late)
    in_time = (F.col("finished") >= F.col("submitted")) & (F.col("finished") <= F.col("submitted") + F.expr(f"INTERVAL {deadline}"))
    return left.join(right, (F.col("job") == F.col("_job")) & in_time, "left_outer").select("job", "submitted", "finished")
