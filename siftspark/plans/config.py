"""Settings of a screening run. Files may be JSON, or YAML where PyYAML is installed."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.operators.filters import PHYSCHEM_BOUNDS, Bounds

MODULES = ("library", "physchem", "admet", "druglikeness", "docking", "results")
INFINITE = {"inf", "+inf", ".inf", "-inf", "-.inf"}


def bound(value: object) -> float | None:
    """A limit as a number; None for infinity, as number or text."""
    if value is None or (isinstance(value, str) and value.strip().lower() in INFINITE):
        return None
    number = float(value)
    return None if number in (float("inf"), float("-inf")) else number


@dataclass(frozen=True)
class Config:
    """``active``: modules to run; ``start``: the first of them, earlier ones count as done."""

    active: tuple[str, ...] = MODULES
    start: str = "library"
    physchem: Bounds = field(default_factory=lambda: dict(PHYSCHEM_BOUNDS))
    physchem_least: int = 11
    admet: Bounds = field(default_factory=lambda: {"score": (0.41, None)})
    models: tuple[str, ...] = ("m1", "m2", "m3", "m4", "m5")
    votes_least: int = 3
    key_residues: tuple[int, ...] = ()
    top_n: int = 500

    def runs(self, module: str) -> bool:
        return module in self.active and MODULES.index(module) >= MODULES.index(self.start)


def gates(runs: DataFrame, modules: tuple[str, ...] = MODULES) -> DataFrame:
    """(..., module, runs): for each run (active: its modules, start: the first of them) whether it runs each module."""
    order = F.array(*map(F.lit, modules))
    each = runs.select("*", F.posexplode(order).alias("_i", "module"))
    from_start = F.col("_i") >= F.array_position(order, F.col("start")) - 1
    return each.withColumn("runs", F.array_contains("active", F.col("module")) & from_start).drop("_i")


def from_mapping(tree: Mapping) -> Config:
    """A config from sections named like the fields; limits are pairs of low and high."""
    tree = dict(tree)
    for section in ("physchem", "admet"):
        if section in tree:
            tree[section] = {k: (bound(v[0]), bound(v[1])) for k, v in tree[section].items()}
    for name in ("active", "models", "key_residues"):
        if name in tree:
            tree[name] = tuple(tree[name])
    return Config(**tree)


def load(path: str) -> Config:
    text = Path(path).read_text()
    if path.endswith((".yaml", ".yml")):
        import yaml

        return from_mapping(yaml.safe_load(text))
    return from_mapping(json.loads(text))
