"""External programs: one on the driver, or one run for each row inside the tasks, with a time limit and a status.

:func:`prepare` and :func:`dock` make equal calls, of the same arguments and input, once and give the result to all their rows.
A task that is run again runs its programs again, so a program must not mind being repeated. Which executors
have GPUs, and how many a task takes, is for the cluster's resource profiles; see :func:`with_gpus`.
"""

from __future__ import annotations

import os
import re
import subprocess
import sys
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftspark.session import find_package


def run_command(command: Sequence[str], out: Callable[[str], object] = sys.stdout.write, check: bool = True, cwd: str | None = None) -> int:
    """Run a program on the driver and pass its output on line by line; a failure raises."""
    with subprocess.Popen(command, stdout=subprocess.PIPE, stderr=subprocess.STDOUT, text=True, cwd=cwd) as run:
        for line in run.stdout:
            out(line)
    if check and run.returncode:
        raise subprocess.CalledProcessError(run.returncode, command)
    return run.returncode


def _run_one(command: Sequence[str], text: str | None, timeout: float, env: dict[str, str] | None) -> tuple[str, str | None]:
    try:
        done = subprocess.run(command, input=text, capture_output=True, text=True, timeout=timeout, env=os.environ | (env or {}), check=False)
    except subprocess.TimeoutExpired:
        return "timeout", None
    except OSError as e:
        return f"not started: {e.strerror}", None
    return ("ok", done.stdout) if done.returncode == 0 else (f"exit {done.returncode}", done.stderr)


def _filled(part: str, row: dict) -> str:
    """The argument with the values of its columns; other braces stay as they are."""
    return re.sub(r"\{(\w+)\}", lambda m: str(row[m[1]]) if m[1] in row else m[0], part)


def for_each(df: DataFrame, command: Sequence[str], stdin: str | None = None, timeout: float = 300.0, env: Callable[[int], dict[str, str]] | None = None) -> DataFrame:
    """Add status (ok, timeout, exit N, not started: why) and output of a program that is run for each row.

    ``{column}`` in an argument stands for a column's value; ``stdin`` names the column that it reads. ``env``: a function
    from the task's number to variables, such as the GPU to use.
    """
    find_package(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        extra = env(TaskContext.get().partitionId()) if env else None
        for batch in batches:
            results = []
            for row in batch.to_dict("records"):
                filled = [_filled(part, row) for part in command]
                text = None if stdin is None else "" if row[stdin] is None else str(row[stdin])
                results.append(_run_one(filled, text, timeout, extra))
            yield batch.assign(status=[r[0] for r in results], output=[r[1] for r in results])

    schema = T.StructType([*df.schema.fields, T.StructField("status", T.StringType()), T.StructField("output", T.StringType())])
    return df.mapInPandas(run, schema)


def _once(df: DataFrame, commands: Sequence[Sequence[str]], stdin: str, run: Callable[[DataFrame], DataFrame], order: str | None = None) -> DataFrame:
    """Add what ``run`` adds, status and output, to the rows with distinct calls: those that differ in a column that a command names or reads."""
    names = {m for command in commands for part in command for m in re.findall(r"\{(\w+)\}", part)} | {stdin}
    keys = [c for c in df.columns if c in names]
    calls = df.groupBy(*keys).agg(F.min(order).alias("_order")) if order else df.select(*keys).distinct()
    done = run(calls).select(*[F.col(c).alias(f"_{k}") for k, c in enumerate(keys)], "status", "output")
    same = [F.col(c).eqNullSafe(F.col(f"_{k}")) for k, c in enumerate(keys)]
    return df.join(done, same).select(*df.columns, "status", "output")


def prepare(df: DataFrame, commands: Sequence[Sequence[str]], stdin: str, timeout: float = 300.0, tasks: int | None = None) -> DataFrame:
    """A chain of programs, each reading what the one before wrote; the first that fails gives the status, the last the output.

    Each program runs once for each distinct call, in ``tasks`` tasks, by default four for each core.
    """
    find_package(df.sparkSession)

    def chained(row: dict) -> tuple[str, str | None]:
        status, text = "ok", row[stdin]
        for command in commands:
            status, text = _run_one([_filled(part, row) for part in command], "" if text is None else str(text), timeout, None)
            if status != "ok":
                break
        return status, text

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            results = [chained(row) for row in batch.to_dict("records")]
            yield batch.assign(status=[r[0] for r in results], output=[r[1] for r in results])

    def in_tasks(calls: DataFrame) -> DataFrame:
        schema = T.StructType([*calls.schema.fields, T.StructField("status", T.StringType()), T.StructField("output", T.StringType())])
        return calls.repartition(tasks or 4 * df.sparkSession.sparkContext.defaultParallelism).mapInPandas(run, schema)

    return _once(df, commands, stdin, in_tasks)


def on_gpus(gpus: int) -> Callable[[int], dict[str, str]]:
    """Tasks take the GPUs of a machine in turn."""
    return lambda task: {"CUDA_VISIBLE_DEVICES": str(task % max(gpus, 1))}


def dock(df: DataFrame, command: Sequence[str], stdin: str, order: str, workers: int, gpus: int = 0, timeout: float = 300.0) -> DataFrame:
    """A program run for each distinct call, on GPUs in turn where there are some; the calls are dealt to ``workers`` tasks by a range of
    the order in which they first come."""
    env = on_gpus(gpus) if gpus else None
    return _once(df, [command], stdin, lambda calls: for_each(calls.repartitionByRange(workers, "_order"), command, stdin, timeout, env), order)


def interactions(complexes: DataFrame, analyse: Callable[[str], tuple[int, int]], key: str = "name", text: str = "value") -> DataFrame:
    """(key, total_hbonds, key_residue_hbonds) by a function of a complex's text; -1 each where it fails."""
    find_package(complexes.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for value in batch[text]:
                try:
                    found.append(analyse(value))
                except Exception:  # noqa: BLE001 - whatever the analysis raises, the row says so
                    found.append((-1, -1))
            yield pd.DataFrame({key: batch[key], "total_hbonds": [f[0] for f in found], "key_residue_hbonds": [f[1] for f in found]})

    return complexes.select(key, text).mapInPandas(run, f"{key} {dict(complexes.dtypes)[key]}, total_hbonds int, key_residue_hbonds int")
