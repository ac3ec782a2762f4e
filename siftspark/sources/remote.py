"""Files from elsewhere, and files changed line by line."""

from __future__ import annotations

import shutil
import urllib.request
from collections.abc import Sequence
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fetch(url: str, path: str, timeout: float = 60.0) -> bool:
    """Put a file where it is missing; False where it was there. What is not whole is not left behind."""
    target = Path(path)
    if target.exists():
        return False
    part = target.with_name(target.name + ".part")
    try:
        with urllib.request.urlopen(url, timeout=timeout) as source, part.open("wb") as out:
            shutil.copyfileobj(source, out)
        part.rename(target)
    finally:
        part.unlink(missing_ok=True)
    return True


def edit_lines(lines: DataFrame, rules: Sequence[tuple[str, str]], drop: str | None = None) -> DataFrame:
    """Lines (value, ...) with regular expressions replaced in turn, without those that match ``drop``."""
    value = reduce(lambda v, rule: F.regexp_replace(v, *rule), rules, F.col("value"))
    kept = lines if drop is None else lines.filter(~F.col("value").rlike(drop))
    return kept.withColumn("value", value)
