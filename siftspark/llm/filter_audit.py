"""What each of several filters removes, in any order of applying them, and its fair share of the whole.

Each document fails some of the filters: a mask of bits. All that any order of the filters does to a part of the
table follows from how many of its documents have which mask, at most two to the power of the filters. These counts
become the part's removal polynomial, the multilinear extension of "how many documents does a set of filters
remove": x_i is the chance that filter i is applied, and a document with mask M is removed with the chance
1 - prod(1 - x_i for i in M). Its value at a corner of the cube is the number that a set of filters removes, from
which the survivors of each step of each order follow. The Shapley value of a filter is the integral of the
polynomial's partial derivative along the diagonal, in exact fractions; times the number of orders it is
what the filter removes in all of them, added up.

The filters, on whole texts (null: empty; words: maximal ``[^\\x20\\x09-\\x0D]+``, case-sensitive), fail a document: A: under 50
words; B: distinct words below 65 % of the words; C: ``[A-Z]`` over 5 % of the code points; D: any of ``#$%&*|``; E: the
text of any smaller doc_id in the whole table. Texts are the same where their SHA-256 is.

No group of equal texts is gathered: the smallest doc_id of each text is an aggregate that combines before its shuffle, and
each row then asks by its own doc_id whether it is one.

Defined results: texts of repeated doc_ids count row by row, and the rows of the smallest one all pass E. A
null doc_id is no smaller than any and passes E; it has no labels. Of several labels of a doc_id any 1 counts. A null
source is the part ``''``. A part with no documents, so any of an empty table, has no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.llm.tokens import pieces, texts_of, words
from siftspark.session import checkpointed, find_package

FILTERS = "ABCDE"
REPEAT = 1 << FILTERS.index("E")


@dataclass(frozen=True)
class Params:
    least_words: int = 50
    distinct_percent: int = 65
    capital_percent: int = 5
    marks: str = "#$%&*|"


# --- what each document fails --------------------------------------------------------------------


def text_masks(texts: pa.Array, params: Params) -> np.ndarray:
    """Bits of the filters A to D that each text fails."""
    flat, ends = words(texts, lower=False)
    n = np.diff(ends)
    which = np.repeat(np.arange(len(n)), n)
    code = flat.dictionary_encode()
    pair = np.unique(which * max(1, len(code.dictionary)) + code.indices.to_numpy(zero_copy_only=False)) // max(1, len(code.dictionary))
    distinct = np.bincount(pair, minlength=len(n)) if len(n) else n
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[: at[-1]] if data is not None else np.zeros(0, np.uint8)
    within = lambda hit: np.diff(np.concatenate([[0], np.cumsum(hit, dtype=np.int64)])[at])
    marked = np.zeros(256, bool)
    marked[list(params.marks.encode())] = True
    failed = (
        n < params.least_words,
        100 * distinct < params.distinct_percent * n,
        100 * within((raw >= ord("A")) & (raw <= ord("Z"))) > params.capital_percent * pc.utf8_length(texts).to_numpy(zero_copy_only=False),
        within(marked[raw]) > 0,
    )
    return sum(f.astype(np.int32) << k for k, f in enumerate(failed))


def failures(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """(doc_id, part, mask), one row per document; written, as the masks are read twice."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            masks = pa.array(text_masks(texts_of(batch), params), pa.int32())
            yield pa.record_batch([batch.column("doc_id"), batch.column("part"), batch.column("text_key"), masks], names=["doc_id", "part", "text_key", "mask"])

    find_package(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    read = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("text_key"), text.alias("text"))
    rows = checkpointed(read.mapInArrow(look, f"doc_id {kind}, part string, text_key binary, mask int"))
    named = rows.filter("doc_id IS NOT NULL")
    first = named.groupBy("text_key").agg(F.min("doc_id").alias("doc_id")).withColumn("_first", F.lit(True))
    repeat = F.when(F.col("_first").isNull(), F.col("mask").bitwiseOR(F.lit(REPEAT))).otherwise(F.col("mask"))
    marked = named.join(first, ["doc_id", "text_key"], "left").withColumn("mask", repeat)
    return marked.select("doc_id", "part", "mask").unionByName(rows.filter("doc_id IS NULL").select("doc_id", "part", "mask"))


def mask_counts(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents, and those labelled good or toxic; combined before the shuffle."""
    one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    known = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(one("quality").alias("_good"), one("toxic").alias("_toxic")).filter("_good OR _toxic")
    named = failed.filter("doc_id IS NOT NULL").join(known, "doc_id", "left")
    nameless = failed.filter("doc_id IS NULL").select("*", F.lit(False).alias("_good"), F.lit(False).alias("_toxic"))
    count = lambda c: F.count(F.when(F.col(c), 1))
    return named.unionByName(nameless).groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), count("_good").alias("good"), count("_toxic").alias("toxic"))


# --- the polynomial ------------------------------------------------------------------------------


class RemovalPolynomial:
    """sum over masks M of n_M (1 - prod(1 - x_i for i in M)), as coefficients of the products of x_i over sets T."""

    def __init__(self, counts: Mapping[int, int], filters: int) -> None:
        self.filters = filters
        # 1 - prod(1 - x_i) over M has for each non-empty T within M the term -(-1)^|T| prod x_i over T.
        self.coefficient = [sum(n for m, n in counts.items() if m & t == t) * (-1) ** (t.bit_count() + 1) if t else 0 for t in range(1 << filters)]
        self._corners = [sum(c for t, c in enumerate(self.coefficient) if t & s == t) for s in range(1 << filters)]

    def corner(self, applied: int) -> int:
        """Where x_i is 1 for the applied filters and 0 for the others: how many documents they remove."""
        return self._corners[applied]

    def shapley(self, i: int) -> Fraction:
        """The integral from 0 to 1 of the derivative by x_i at (t, ..., t): each T with i gives c t^(|T| - 1)."""
        return sum((Fraction(c, t.bit_count()) for t, c in enumerate(self.coefficient) if t >> i & 1), Fraction(0))


def part_rows(n: Mapping[int, int], good: Mapping[int, int], toxic: Mapping[int, int], names: str = FILTERS) -> list[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for all orders of one part."""
    k, every = len(names), (1 << len(names)) - 1
    whole, well, ill = (RemovalPolynomial(x, k) for x in (n, good, toxic))
    total, failing = sum(n.values()), [whole.corner(1 << i) for i in range(k)]
    alone = [whole.corner(every) - whole.corner(every & ~(1 << i)) for i in range(k)]
    share = [whole.shapley(i) * factorial(k) for i in range(k)]
    if any(s.denominator != 1 for s in share):
        raise ArithmeticError("a sum over all orders is a whole number")
    rows = []
    for order in permutations(range(k)):
        name, before = "".join(names[i] for i in order), 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            removed = whole.corner(after) - whole.corner(before)
            lost = (p.corner(after) - p.corner(before) for p in (well, ill))
            rows.append((name, step, total - whole.corner(after), removed, failing[i] - removed, alone[i], *lost, share[i].numerator))
            before = after
    return rows


OUT = "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"


def audit(counts: DataFrame, names: Sequence[str] = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from (part, mask, n, good, toxic); a part has one row of counts at most
    for each mask, and these meet in one group."""

    def all_orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
        columns = [c.split()[0] for c in OUT.split(", ")]
        for batch in batches:
            for part, masks in zip(batch.column("part").to_pylist(), batch.column("masks").to_pylist(), strict=True):
                rows = part_rows(*({x["mask"]: x[c] for x in masks} for c in ("n", "good", "toxic")), names)
                yield pa.record_batch([pa.array(c, kind) for c, kind in zip(([part] * len(rows), *zip(*rows, strict=True)), kinds, strict=True)], names=columns)

    find_package(counts.sparkSession)
    return counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks")).mapInArrow(all_orders, OUT)


def filter_audit(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """The audit of the five filters for each source."""
    return audit(mask_counts(failures(docs, params), labels))
