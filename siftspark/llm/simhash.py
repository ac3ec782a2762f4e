"""Near duplicates by SimHash fingerprints and vantage-point trees.

Every word shingle of a text has a 64-bit hash; a fingerprint bit is set where
over half of the hashes have it. Fingerprints that differ in few bits link
their documents. The links are found exactly: a vantage-point tree, built from
a bounded sample of the distinct fingerprints, deals them to shards by their
Hamming distances to the vantage points. Two fingerprints within the radius
differ in their distance to any point by the radius at most (triangle
inequality), so where a split parts such a pair, its inner one lies within the
radius of the boundary; those inner ones go to the outer side as well. Inside
a shard the same splits go on until the parts are small, and the rest is
compared directly, with the same bound. A shard reports a spanning forest of its
links, never all pairs.

Defined results: null text counts as empty; a text without words has the
fingerprint zero, which links like any other. Repeated rows and equal texts
have equal fingerprints; rows of one doc_id are one document, so all their
fingerprints link. A null doc_id takes no part in naming a component; a component
of such rows only is named null. Ids that are no integers are numbered in their
order for the search. An empty table gives an empty result; other columns are
ignored by :func:`near_duplicates` and kept untouched by :func:`drop_near_duplicates`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.llm.components import components, join_hot
from siftspark.llm.order import order_table, with_order
from siftspark.llm.tokens import mixed, pieces, ragged, runs, texts_of, words
from siftspark.session import find_package

SEED = 42


@dataclass(frozen=True)
class Params:
    """``shingle``: words in one; ``radius``: most differing bits of a link.

    ``leaf``: fingerprints that one shard should hold; ``sample``: fingerprints
    that the tree over the shards is built from, at most about so many in memory.
    """

    shingle: int = 3
    radius: int = 3
    leaf: int = 50_000
    sample: int = 50_000
    small: int = 256


#: The primes of XXH64.
PRIMES = tuple(map(np.uint64, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)))


def _turned(x: np.ndarray, n: int) -> np.ndarray:
    return x << np.uint64(n) | x >> np.uint64(64 - n)


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turned(acc + lane * PRIMES[1], 31) * PRIMES[0]


def xxh64(raw: np.ndarray, begin: np.ndarray, size: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of many stretches of bytes, all together: each step takes the stretches that have so many bytes left."""
    p1, p2, p3, p4, p5 = PRIMES
    raw = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    seed_ = np.uint64(seed)
    with np.errstate(over="ignore"):
        h = np.full(len(begin), seed_ + p5)
        long = np.flatnonzero(size >= 32)
        if len(long):
            lanes = [np.full(len(long), v) for v in (seed_ + p1 + p2, seed_ + p2, seed_, seed_ - p1)]
            at, stripes = begin[long], size[long] // 32
            for k in range(int(stripes.max())):
                on = np.flatnonzero(stripes > k)
                for i in range(4):
                    lanes[i][on] = _round(lanes[i][on], eight[at[on] + 32 * k + 8 * i])
            merged = sum((_turned(v, n) for v, n in zip(lanes[1:], (7, 12, 18), strict=True)), _turned(lanes[0], 1))
            for v in lanes:
                merged = (merged ^ _round(np.zeros_like(v), v)) * p1 + p4
            h[long] = merged
        h += size.astype(np.uint64)
        at, left = begin + size // 32 * 32, size % 32
        for k in range(3):
            on = np.flatnonzero(left >= 8 * (k + 1))
            h[on] = _turned(h[on] ^ _round(np.zeros(len(on), np.uint64), eight[at[on] + 8 * k]), 27) * p1 + p4
        at, left = at + left // 8 * 8, left % 8
        on = np.flatnonzero(left >= 4)
        h[on] = _turned(h[on] ^ (eight[at[on]] & np.uint64(0xFFFFFFFF)) * p1, 23) * p2 + p3
        at, left = at + left // 4 * 4, left % 4
        for k in range(3):
            on = np.flatnonzero(left > k)
            h[on] = _turned(h[on] ^ raw[at[on] + k].astype(np.uint64) * p5, 11) * p1
        h ^= h >> np.uint64(33)
        h *= p2
        h ^= h >> np.uint64(29)
        h *= p3
        return h ^ h >> np.uint64(32)


#: Hashes whose bits are counted together.
BITS = 1 << 17


def fingerprints_of(texts: pa.Array, shingle: int) -> np.ndarray:
    """One unsigned 64-bit fingerprint per text."""
    flat, off = words(texts)
    n = np.diff(off)
    # All words in a row, each after one space: a shingle is a stretch of these bytes.
    raw, ends = _spaced(flat)
    starts = np.concatenate([[0], ends])
    count = np.where(n > 0, np.maximum(n - shingle + 1, 1), 0)
    first = ragged(off[:-1], count)
    last = np.minimum(first + shingle, np.repeat(off[1:], count)) - 1
    text = np.repeat(np.arange(len(n)), count)
    ones = np.zeros((len(n), 64), np.int64)
    for k in range(0, len(first), BITS):
        part = slice(k, k + BITS)
        hashes = xxh64_at(raw, starts[first[part]], ends[last[part]] - 1)
        new = np.flatnonzero(runs(text[part]))
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for t, x, y in zip(text[part][new].tolist(), new.tolist(), [*new[1:].tolist(), len(bits)], strict=True):
            ones[t] += bits[x:y].sum(0, dtype=np.int64)
    return np.packbits(2 * ones > count[:, None], axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def _spaced(flat: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words with one space after each, and where each ends, its space included."""
    _, offsets, data = flat.buffers()
    if not len(flat):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    at = np.frombuffer(offsets, np.int64 if pa.types.is_large_string(flat.type) else np.int32)[flat.offset : flat.offset + len(flat) + 1].astype(np.int64)
    size = np.diff(at)
    raw = np.full(int(size.sum()) + len(flat), 32, np.uint8)
    raw[np.arange(size.sum()) + np.repeat(np.arange(len(flat)), size)] = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    return raw, np.cumsum(size + 1)


def xxh64_at(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hashes of stretches that lie close together: only the bytes around them are copied."""
    low, high = int(begin.min()), int(end.max())
    return xxh64(raw[low:high], begin - low, end - begin)


def fingerprints(docs: DataFrame, params: Params, *keep: str) -> DataFrame:
    """``keep`` and ``fp``, the fingerprint as a signed long."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            fp = fingerprints_of(texts_of(batch), params.shingle).view(np.int64)
            yield pa.record_batch([*(batch.column(k) for k in keep), pa.array(fp)], names=[*keep, "fp"])

    find_package(docs.sparkSession)
    kinds = dict(docs.dtypes)
    return docs.select(*keep, "text").mapInArrow(make, ", ".join(f"{k} {kinds[k]}" for k in keep) + ", fp bigint")


def _distance(x: np.ndarray, v: np.uint64) -> np.ndarray:
    return np.bitwise_count(x ^ v).astype(np.int16)


def split_point(x: np.ndarray, rng: np.random.Generator, radius: int) -> tuple[np.uint64, int] | None:
    """A vantage point and the distance that parts x best, counting the boundary twice; None if none helps."""
    best: tuple[float, np.uint64, int] | None = None
    for v in x[rng.integers(0, len(x), 6)]:
        counts = np.bincount(_distance(x, v), minlength=65)
        inner = np.cumsum(counts)  # within m
        edge = inner - np.concatenate([np.zeros(radius, inner.dtype), inner])[: len(inner)]
        outer = len(x) - inner + edge
        cost = inner.astype(float) ** 2 + outer.astype(float) ** 2
        cost[(inner == 0) | (inner == len(x))] = np.inf
        m = int(np.argmin(cost))
        if best is None or cost[m] < best[0]:
            best = (float(cost[m]), v, m)
    return None if best is None or best[0] > 0.9 * len(x) ** 2 else (best[1], best[2])


class Tree:
    """Splits over the shards: nodes of (vantage point, distance, inner, outer).

    A leaf is (first shard, blocks). Where no split helps, as in a large group of
    fingerprints that are all alike, the fingerprints of a leaf fall into blocks
    and each pair of blocks is a shard, so that no shard outgrows the others.
    """

    def __init__(self, sample: np.ndarray, n: int, leaf: int, radius: int) -> None:
        rng = np.random.default_rng(SEED)
        self.radius, self.shards = radius, 0
        sample = np.unique(sample)
        self.weight = max(1.0, n / max(1, len(sample))) / leaf
        self.root = self._build(sample, rng)

    def _build(self, x: np.ndarray, rng: np.random.Generator) -> tuple:
        point = split_point(x, rng, self.radius) if len(x) * self.weight > 1 and len(x) > 16 else None
        if point is None:
            blocks = 1 if len(x) * self.weight < 2 else 1 + int(len(x) * self.weight)
            self.shards += max(1, blocks * (blocks - 1) // 2)
            return self.shards, blocks
        d = _distance(x, point[0])
        return (*point, self._build(x[d <= point[1]], rng), self._build(x[d > point[1] - self.radius], rng))

    def deal(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Shard and the places in x of what it gets."""
        work = [(self.root, np.arange(len(x)))]
        while work:
            node, at = work.pop()
            if not len(at):
                continue
            if len(node) == 2:
                shard, blocks = node
                block = mixed(x[at]) % np.uint64(blocks)
                for i in range(blocks):
                    for j in range(i + 1, blocks):
                        yield (shard := shard - 1), at[(block == i) | (block == j)]
                if blocks == 1:
                    yield shard - 1, at
                continue
            v, m, inner, outer = node
            d = _distance(x[at], v)
            work += [(inner, at[d <= m]), (outer, at[d > m - self.radius])]


class _Forest:
    """Union-find over places, with the root of every place kept up to date."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def absorb(self, p: np.ndarray, q: np.ndarray) -> None:
        """Join the pairs (p, q); what is joined already costs no step of its own."""
        while True:
            apart = self.root[p] != self.root[q]
            p, q = p[apart], q[apart]
            if not len(p):
                return
            _, first = np.unique(self.root[q], return_index=True)
            up = self.root.copy()
            for i, j in zip(p[first].tolist(), q[first].tolist(), strict=True):
                a, b = _top(up, self.root[i]), _top(up, self.root[j])
                if a != b:
                    up[max(a, b)] = min(a, b)
                    self.links.append((i, j))
            while not np.array_equal(flat := up[up], up):
                up = flat
            self.root = up


def _top(up: np.ndarray, i: int) -> int:
    while up[i] != i:
        i = up[i]
    return int(i)


def spanning_links(x: np.ndarray, radius: int, small: int = 256) -> list[tuple[int, int]]:
    """Places in x (distinct) joined by links of at most ``radius`` bits: a spanning forest of them."""
    rng = np.random.default_rng(SEED)
    forest = _Forest(len(x))
    work = [np.arange(len(x))]
    while work:
        at = work.pop()
        point = split_point(x[at], rng, radius) if len(at) > small else None
        if point is not None:
            d = _distance(x[at], point[0])
            work += [at[d <= point[1]], at[d > point[1] - radius]]
            continue
        y = x[at]
        for a in range(0, len(y), 512):
            for b in range(a, len(y), 4096):
                near = np.bitwise_count(y[a : a + 512, None] ^ y[None, b : b + 4096]) <= radius
                i, j = np.nonzero(near)
                later = b + j > a + i
                forest.absorb(at[a + i[later]], at[b + j[later]])
    return forest.links


def fingerprint_links(distinct: DataFrame, params: Params) -> DataFrame:
    """(a, b): links that span the components of the distinct fingerprints ``fp``.

    The tree is broadcast inside the tasks; its size follows ``sample``, not the data.
    """
    n = distinct.count()
    share = min(1.0, params.sample / max(n, 1))
    drawn = distinct.filter(F.pmod(F.xxhash64(F.lit(SEED), "fp"), F.lit(2**53)) < int(share * 2**53) + 1).select("fp")
    sample = np.array([r["fp"] for r in drawn.limit(4 * params.sample).collect()], np.int64).view(np.uint64)
    tree = Tree(sample, n, params.leaf, params.radius)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for shard, at in tree.deal(fp):
                yield pa.record_batch([pa.array(np.full(len(at), shard, np.int32)), batch.column("fp").take(pa.array(at))], names=["shard", "fp"])

    def link(part: pa.Table) -> pa.Table:
        fp = part.column("fp").to_numpy()
        pairs = np.array(spanning_links(fp.view(np.uint64), params.radius, params.small), np.int64).reshape(-1, 2)
        return pa.table({"a": fp[pairs[:, 0]], "b": fp[pairs[:, 1]]})

    return distinct.select("fp").mapInArrow(deal, "shard int, fp bigint").groupBy("shard").applyInArrow(link, "a bigint, b bigint")


def fingerprint_classes(rows: DataFrame, params: Params) -> tuple[DataFrame, DataFrame]:
    """(fp, component) of each distinct fingerprint in ``rows`` (_o, doc_id, fp), the component by its smallest _o, null
    where no row has an id; and the frequent fingerprints. Links and components are of fingerprints, so any id will do."""
    from siftspark.session import checkpointed

    named_rows = rows.filter("doc_id IS NOT NULL")
    distinct = checkpointed(rows.groupBy("fp").agg(F.min(F.when(F.col("doc_id").isNotNull(), F.col("_o"))).alias("least"), F.count("*").alias("n")))
    links = fingerprint_links(distinct, params)
    several = checkpointed(named_rows.groupBy("_o").agg(F.min("fp").alias("a"), F.max("fp").alias("y")).filter("a != y").select("_o", "a"))
    if several.limit(1).count():
        links = links.union(named_rows.join(several, "_o").select("a", F.col("fp").alias("b")))
    rooted = checkpointed(distinct.join(components(links), F.col("fp") == F.col("v"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    # Most fingerprints are their own component; the others' least id is an aggregate of one row for each of them.
    names = rooted.groupBy("root").agg(F.min("least").alias("component"))
    classes = checkpointed(rooted.select("fp", "root").join(names, "root").select("fp", "component"))
    return classes, distinct.select("fp", "n")


def near_duplicates(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per document: fingerprint and component_id, the smallest doc_id it reaches."""
    from siftspark.session import checkpointed

    ids = order_table(docs)
    rows = checkpointed(fingerprints(with_order(docs.select("doc_id", "text"), ids), params, "doc_id", "_o"))
    found = join_hot(rows, *fingerprint_classes(rows, params), "fp")
    if ids is not None:
        found = found.drop("_o").join(ids.select(F.col("doc_id").alias("_root"), F.col("_o").alias("component")), "component", "left").withColumn("component", F.col("_root"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """The documents, with all their columns, of which each component keeps the one with the smallest id; of several
    texts with that id the one with the smallest hash. Rows without an id all stay."""
    from siftspark.session import checkpointed

    ids = order_table(docs)
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_key")
    keyed = with_order(docs.select("doc_id", "text"), ids).select("doc_id", "_o", "text", key)
    rows = checkpointed(fingerprints(keyed, params, "doc_id", "_o", "_key").filter("doc_id IS NOT NULL"))
    found = join_hot(rows, *fingerprint_classes(rows, params), "fp")
    kept = checkpointed(found.filter("_o = component").groupBy("_o").agg(F.min("_key").alias("_key")))
    row = with_order(docs.select(F.struct("*").alias("_row"), "doc_id", key), ids).filter("doc_id IS NOT NULL")
    stay = row.join(kept, ["_o", "_key"]).dropDuplicates(["_o", "_key"])
    return stay.select("_row.*").unionByName(docs.filter("doc_id IS NULL"))
