"""Benchmark decontamination by spaced seeds.

A benchmark item leaks into a document where a window of it lines up with a
window of the document and at least four tokens in five are the same. Fixed
masks pick token positions of such a window and ignore the others; the picked
tokens of benchmark and documents are hashed and joined, and around each hit
the tokens on the same alignment are compared one by one. The two masks
together hit every window of 13 tokens with up to two substitutions, wherever
these are (tests go through all cases), so nothing within the tolerance is
missed.

The hashes of the benchmark go to the tasks in blocks of bounded size. Documents
never move. A benchmark of several blocks is searched one block after the other;
what is found is written before the next block is read, so that only one is in memory.

Tokens are lower-cased stretches between white space without the ASCII
punctuation at their ends. Defined results: null text counts as empty and leaks
nothing; items with fewer tokens than the window cannot be told from chance and
are not searched; items with equal tokens count as the one with the smallest
id; items without an id are not searched. Repeated rows are judged alike; an
empty table on either side gives no leaks; other columns are ignored by
:func:`leaks` and kept untouched by :func:`drop_leaks`.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftspark.llm.tokens import mixed, pieces, ragged, texts_of
from siftspark.session import find_package

#: Positions that each mask looks at.
MASKS = ((0, 1, 3, 5, 6, 7), (0, 1, 2, 3, 6, 8))


@dataclass(frozen=True)
class Params:
    """``window`` tokens of which ``least_equal`` must agree; ``block_chars``: benchmark text in one block."""

    window: int = 13
    least_equal: int = 11
    block_chars: int = 4_000_000


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Normalised tokens of each text, and offsets by text."""
    parts = pc.ascii_split_whitespace(pc.utf8_lower(texts))
    flat = pc.utf8_trim(parts.flatten(), characters=string.punctuation)
    full = pc.greater(pc.binary_length(flat), 0)
    ends = np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64))
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False).astype(np.int64))])
    return flat.filter(full), np.concatenate([[0], kept[ends]]) if len(ends) else np.zeros(1, np.int64)


def seed_hashes(ids: np.ndarray, row: np.ndarray, mask: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Places where the mask fits inside a row and sees only known tokens (id >= 0), and the hashes there."""
    n = len(ids) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    known = ids >= 0
    fits = row[:n] == row[mask[-1] :]
    for o in mask:
        fits = fits & known[o : o + n]
    at = np.flatnonzero(fits)
    h = np.zeros(len(at), np.uint64)
    for o in mask:
        h = mixed(h + ids[at + o].astype(np.uint64) + np.uint64(1))
    return at, h


class Seeds:
    """A block of benchmark items: token ids, and for each mask its sorted hashes with their places."""

    def __init__(self, items: list[tuple[int, str]], params: Params) -> None:
        flat, off = tokens(pa.array([text for _, text in items], pa.large_string()))
        self.vocabulary = flat.unique()
        ids = pc.index_in(flat, value_set=self.vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
        seen: dict[bytes, int] = {}
        for k in sorted(range(len(items)), key=lambda k: items[k][0]):
            part = ids[off[k] : off[k + 1]]
            if len(part) >= params.window:
                seen.setdefault(part.tobytes(), k)
        chosen = sorted(seen.values(), key=lambda k: items[k][0])
        self.item_id = np.array([items[k][0] for k in chosen], np.int64)
        self.ids = np.concatenate([np.zeros(0, np.int64), *(ids[off[k] : off[k + 1]] for k in chosen)])
        sizes = np.array([off[k + 1] - off[k] for k in chosen], np.int64)
        self.start = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.row = np.repeat(np.arange(len(chosen)), sizes)
        self.tables = []
        for mask in MASKS:
            at, h = seed_hashes(self.ids, self.row, mask)
            order = np.argsort(h, kind="stable")
            self.tables.append((h[order], at[order]))


#: Seed hits that are looked at together.
HITS = 1 << 20


def alignments(ids: np.ndarray, row: np.ndarray, seeds: Seeds) -> np.ndarray:
    """Distinct (text, item, place of the item's start relative to the tokens) of all seed hits.

    Hits are expanded a bounded number at a time: of a word repeated on both sides there are as many as
    the product of its counts, but no more alignments than the sum of the lengths.
    """
    found = np.zeros((0, 3), np.int64)
    for mask, (table, places) in zip(MASKS, seeds.tables, strict=True):
        at, h = seed_hashes(ids, row, mask)
        lo = np.searchsorted(table, h, "left")
        n = np.searchsorted(table, h, "right") - lo
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        total = np.concatenate([[0], np.cumsum(n)])
        done = 0
        while done < len(at):
            end = max(done + 1, int(np.searchsorted(total, total[done] + HITS, "right")) - 1)
            k = slice(done, end)
            p, q = np.repeat(at[k], n[k]), places[ragged(lo[k], n[k])]
            item = seeds.row[q]
            found = _distinct(np.concatenate([found, np.column_stack([row[p], item, p - (q - seeds.start[item])])]))
            done = end
    return found


def _distinct(x: np.ndarray) -> np.ndarray:
    """Distinct rows, sorted."""
    x = x[np.lexsort(x.T[::-1])]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]).any(1)
    return x[new]


def overlaps(ids: np.ndarray, off: np.ndarray, row: np.ndarray, seeds: Seeds, params: Params) -> list[tuple[int, int, int, int]]:
    """(text, item, first, last) of the stretches that windows of tokens cover that agree closely enough, places counted over all texts."""
    out = []
    for text, item, shift in alignments(ids, row, seeds).tolist():
        a, b = int(seeds.start[item]), int(seeds.start[item + 1])
        # The part of the item that lies inside the text.
        skip = max(0, int(off[text]) - shift)
        n = min(b - a, int(off[text + 1]) - shift)
        if n - skip < params.window:
            continue
        same = ids[shift + skip : shift + n] == seeds.ids[a + skip : a + n]
        total = np.concatenate([[0], np.cumsum(same)])
        close = np.flatnonzero(total[params.window :] - total[: -params.window] >= params.least_equal)
        if len(close):
            apart = np.flatnonzero(np.diff(close) > params.window)
            first, last = close[np.append(0, apart + 1)], close[np.append(apart, len(close) - 1)]
            out += [(text, item, shift + skip + int(x), shift + skip + int(y) + params.window) for x, y in zip(first, last, strict=True)]
    return out


def blocks(items: DataFrame, params: Params) -> Iterator[tuple[int, Seeds]]:
    """The number of blocks of about ``block_chars`` characters that the benchmark has, with each; equal texts fall into one block."""
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").dropna()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // params.block_chars)
    for k in range(n):
        yield n, Seeds([(r["item_id"], r["text"]) for r in items.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == k).collect()], params)


def _scan(batch: pa.RecordBatch, seeds: Seeds, params: Params) -> tuple[np.ndarray, list[tuple[int, int, int, int]]]:
    """Token counts of the texts, and the stretches with places counted from each text's start."""
    flat, off = tokens(texts_of(batch))
    ids = pc.fill_null(pc.index_in(flat, value_set=seeds.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    return np.diff(off), [(t, i, int(a - off[t]), int(b - off[t])) for t, i, a, b in overlaps(ids, off, row, seeds, params)]


SPAN = "struct<item_id:bigint,first:int,last:int>"
SPANS = pa.list_(pa.struct([("item_id", pa.int64()), ("first", pa.int32()), ("last", pa.int32())]))


def _spans(docs: DataFrame, seeds: Seeds, params: Params) -> DataFrame:
    """(_key, n_tokens, spans) of the texts (_key, text) for one block."""
    kind = dict(docs.dtypes)["_key"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            n, hits = _scan(batch, seeds, params)
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for (t, i), (a, b) in _stretches(hits):
                spans[t].append({"item_id": int(seeds.item_id[i]), "first": a, "last": b})
            yield pa.record_batch([batch.column("_key"), pa.array(n, pa.int64()), pa.array(spans, SPANS)], names=["_key", "n_tokens", "spans"])

    return docs.select("_key", "text").mapInArrow(scan, f"_key {kind}, n_tokens bigint, spans array<{SPAN}>")


def _n_tokens() -> Column:
    """Where there is no benchmark to scan for."""
    trimmed = F.transform(F.split(F.lower(F.coalesce("text", F.lit(""))), "[\\x20\\x09-\\x0D]+"), lambda w: F.btrim(w, F.lit(string.punctuation)))
    return F.size(F.filter(trimmed, lambda w: w != "")).cast("bigint")


def leaks(docs: DataFrame, items: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per document: n_tokens, the benchmark items found in it, and ``spans``: for each item the
    stretches of tokens (first, last exclusive) that windows of it cover."""
    from siftspark.session import checkpointed

    find_package(docs.sparkSession)
    base = docs.select("doc_id", "text")
    found = None
    for n, seeds in blocks(items, params):
        if n == 1:
            found = _spans(base.withColumnRenamed("doc_id", "_key"), seeds, params).withColumnRenamed("_key", "doc_id")
            break
        if found is None:  # rows keep a number from block to block
            numbered = checkpointed(base.withColumn("_key", F.monotonically_increasing_id()))
        hits = checkpointed(_spans(numbered, seeds, params).filter(F.size("spans") > 0).select("_key", "spans"))
        found = hits if found is None else checkpointed(found.union(hits).groupBy("_key").agg(F.flatten(F.collect_list("spans")).alias("spans")))
    none = F.array().cast(f"array<{SPAN}>")
    if found is None:
        found = base.select("doc_id", _n_tokens().alias("n_tokens"), none.alias("spans"))
    elif "_key" in found.columns:
        found = numbered.join(found, "_key", "left").select("doc_id", _n_tokens().alias("n_tokens"), F.coalesce("spans", none).alias("spans"))
    items_of = F.sort_array(F.array_distinct(F.transform("spans", lambda s: s["item_id"])))
    return found.select("doc_id", "n_tokens", F.size(items_of).alias("n_items"), items_of.alias("items"), F.sort_array("spans").alias("spans"))


def _stretches(hits: list[tuple[int, int, int, int]]) -> Iterator[tuple[tuple[int, int], tuple[int, int]]]:
    """Overlapping stretches of the same text and item put together."""
    merged: list[list[int]] = []
    for t, i, a, b in sorted(hits):
        if merged and merged[-1][:2] == [t, i] and a <= merged[-1][3]:
            merged[-1][3] = max(merged[-1][3], b)
        else:
            merged.append([t, i, a, b])
    yield from (((t, i), (a, b)) for t, i, a, b in merged)


def drop_leaks(docs: DataFrame, items: DataFrame, params: Params = Params()) -> DataFrame:
    """The documents, with all their columns, that no benchmark item leaks into."""
    from siftspark.session import checkpointed

    find_package(docs.sparkSession)
    kept = docs
    for n, seeds in blocks(items, params):

        def clean(batches: Iterator[pa.RecordBatch], seeds: Seeds = seeds) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches):
                _, hits = _scan(batch, seeds, params)
                keep = np.ones(batch.num_rows, bool)
                keep[[t for t, *_ in hits]] = False
                yield batch.filter(pa.array(keep))

        kept = kept.mapInArrow(clean, docs.schema)
        if n > 1:  # the block can go before the next comes
            kept = checkpointed(kept)
    return kept
