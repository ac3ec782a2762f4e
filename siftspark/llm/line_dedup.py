"""Line deduplication by an exact set-similarity join.

A line is the set of its words. A line goes if an earlier line, in order of
doc_id and line number, has a Jaccard similarity of at least the threshold.
Equal sets are settled by their hash, so that copies cost little. The distinct
sets are joined by prefix filtering: with the words of each set in one global
order, rare ones first, two similar sets share a word among their first few.
Candidates also pass the length filter, the positional filter and a bound from
parity sketches; the rest is verified on the whole sets.

The texts are read once. Each piece of them becomes one row of a written table:
its distinct words, its distinct sets as places among these, and its lines. All
further steps work on that table. How frequent a word is comes from an array of
fixed size over all texts, in which words share slots; ties go by hash, and any
order that is the same everywhere gives the same result. Prefix words that would
gather too many sets in one task are dealt to pairs of blocks. In each task a set
offers its earliest few candidates; the few sets that none of those remove and
that had more are compared with all sets that share a prefix word with them: the
former are broadcast where they are few, else both meet in a shuffle by that word.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, lines end at ``\\n``.
Words are compared by 48-bit hashes, which two different words of a line pair
share with a chance below one in 10 ** 10. Defined results: null text counts as
empty; lines without a word always stay. Between rows of one doc_id the order
goes on by line number and then by a hash of the line's words or, for equal
ones, of the text, so repeated rows keep or lose the same lines; a null doc_id
comes first. Ids that are no integers are numbered in their order first. An empty
table gives an empty result; other columns are ignored by :func:`line_verdicts`
and kept untouched by :func:`drop_lines`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftspark.llm.order import order_table, with_order
from siftspark.llm.tokens import SLICED, Filter, added, expand, filter_of, hashed, mixed, pack, pieces, ragged, runs, sliced, squeeze, texts_of, unpack, words
from siftspark.session import find_package


@dataclass(frozen=True)
class Params:
    """Threshold ``num / den``. ``slots``: a power of two, the size of the frequency array; ``block``:
    sets with one prefix word that one task should compare; ``few``: candidates that a set offers at first."""

    num: int = 4
    den: int = 5
    slots: int = 1 << 18
    block: int = 20_000
    few: int = 16
    #: Sets from this size on have sketches of two words, as one is soon full, and those of twice the size have four.
    wide: int = 64
    #: Words of all sets without a verified candidate up to which these are broadcast to be compared with all; more of them meet by shuffle.
    broadcast: int = 4_000_000
    #: Prefix words that one task should get, and the bytes of text in one piece.
    bucket: int = 200_000
    piece: int = 4 << 20
    #: 0: the sets are the words of each line; k: the k-word shingles of each whole text, as one line.
    shingle: int = 0


#: Bits of a word's hash.
WORD_BITS = 48
LOW = np.uint64(2**32 - 1)


def _slot(keys: np.ndarray, slots: int) -> np.ndarray:
    return (keys >> np.uint64(WORD_BITS - (slots.bit_length() - 1))).astype(np.int64)


# --- pieces ------------------------------------------------------------------------------------


@dataclass
class Piece:
    """The lines with words of some texts: row (the text's place), number, and which of the distinct sets each is.

    Set j has the id set_id[j] and the words keys[codes[off[j]:off[j + 1]]]; keys are sorted 48-bit hashes.
    """

    row: np.ndarray
    number: np.ndarray
    which: np.ndarray
    set_id: np.ndarray
    codes: np.ndarray
    off: np.ndarray
    keys: np.ndarray

    @property
    def n(self) -> np.ndarray:
        return np.diff(self.off)

    def words(self, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The word hashes of some sets, and their number."""
        n = self.n[sets]
        return self.keys[self.codes[ragged(self.off[sets], n)]], n


def _lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """row and number of every line; the sorted word hashes, the place among these of each word, and offsets by line."""
    parts = pc.split_pattern(texts, "\n")
    n = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    flat, off = words(parts.flatten())
    coded = flat.dictionary_encode()
    keys, place = np.unique(hashed(coded.dictionary) >> np.uint64(64 - WORD_BITS), return_inverse=True)
    return np.repeat(np.arange(len(n)), n), ragged(np.zeros(len(n), np.int64), n), keys, place[coded.indices.to_numpy()], off


def _shingles(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same of whole texts, by the hashes of their shingles; a shorter text is one shingle, padded."""
    flat, off = words(texts)
    n = np.diff(off).astype(np.int64)
    m = np.maximum(n, shingle)
    begin = np.cumsum(m) - m
    padded = np.zeros(int(m.sum()), np.uint64)
    padded[ragged(begin, n)] = hashed(flat)
    at = ragged(begin, m - shingle + 1)
    h = padded[at]
    for k in range(1, shingle):
        h = mixed(h) + padded[at + k]
    keys, codes = np.unique(mixed(h) >> np.uint64(64 - WORD_BITS), return_inverse=True)
    row = np.arange(len(n))
    return row, np.zeros_like(row), keys, codes, np.concatenate([[0], np.cumsum(m - shingle + 1)]).astype(np.int64)


def piece_of(texts: pa.Array, shingle: int = 0) -> Piece:
    row, number, keys, codes, off = _shingles(texts, shingle) if shingle else _lines(texts)
    line = np.repeat(np.arange(len(off) - 1, dtype=np.uint64), np.diff(off))
    both = np.sort(line << np.uint64(32) | codes.astype(np.uint64))
    both = both[runs(both)]
    line, codes = (both >> np.uint64(32)).astype(np.int64), (both & LOW).astype(np.int64)
    start = np.flatnonzero(runs(line))
    n = np.diff(np.append(start, len(line)))
    total = np.add.reduceat(mixed(keys)[codes], start) if len(start) else np.zeros(0, np.uint64)
    set_id, first, which = np.unique(mixed(total + n.astype(np.uint64)).view(np.int64), return_index=True, return_inverse=True)
    filled = line[start]
    size = n[first]
    return Piece(row[filled], number[filled], which, set_id, codes[ragged(start[first], size)], np.concatenate([[0], np.cumsum(size)]), keys)


#: A row for each piece, in binary: place in the order and text key of each text; of the lines, the text, the number and
#: the set; of the sets, the ids, the sizes and the words (as differences of places); and the words (as differences).
#: Rows of their own (k, v) hold how often the words of each slot occur.
PIECES = f"piece bigint, o binary, text_key binary, row binary, number binary, which binary, set_id binary, size binary, codes binary, keys binary, {SLICED}"
_KINDS = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    return pa.record_batch([pa.array(c, _KINDS[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _table(rows: list[tuple], schema: str) -> pa.Table:
    return pa.Table.from_batches([_batch(rows, schema)])


def _differences(codes: np.ndarray, off: np.ndarray) -> np.ndarray:
    out = np.diff(codes, prepend=0)
    out[off[:-1]] = codes[off[:-1]]
    return out


def _summed(steps: np.ndarray, off: np.ndarray) -> np.ndarray:
    """What :func:`_differences` took."""
    total = np.cumsum(steps)
    start = off[:-1]
    return total - np.repeat(total[start] - steps[start], np.diff(off))


def piece_table(docs: DataFrame, params: Params) -> DataFrame:
    """The written pieces of texts (_o, text, text_key)."""
    from pyspark import TaskContext

    from siftspark.session import checkpointed

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        counts = np.zeros(params.slots, np.int64)
        for batch in pieces(batches, limit=params.piece):
            p = piece_of(texts_of(batch), params.shingle)
            np.add.at(counts, _slot(p.keys, params.slots), np.bincount(p.codes, minlength=len(p.keys)))
            ids = [pack(batch.column(c).to_numpy(zero_copy_only=False)) for c in ("_o", "text_key")]
            lines = [squeeze(np.diff(p.row, prepend=0)), squeeze(p.number), squeeze(p.which)]
            sets = [pack(p.set_id), squeeze(p.n), squeeze(_differences(p.codes, p.off)), squeeze(np.diff(p.keys, prepend=np.uint64(0)))]
            yield _batch([(number, *ids, *lines, *sets, None, None)], PIECES)
            number += 1
        for part in sliced(np.minimum(counts, 2**32 - 1)):
            yield _batch([(None, *[None] * 9, part.column(0)[0].as_py(), part.column(1)[0].as_py())], PIECES)

    find_package(docs.sparkSession)
    return checkpointed(docs.select("_o", "text", "text_key").mapInArrow(make, PIECES))


def _sets_of(batch: pa.RecordBatch) -> Iterator[tuple[dict, Piece]]:
    """The rows of a batch of pieces, with the sets of each; the lines stay packed."""
    for r in batch.to_pylist():
        off = np.concatenate([[0], np.cumsum(expand(r["size"]))])
        keys = np.cumsum(expand(r["keys"]).view(np.uint64), dtype=np.uint64)
        codes = _summed(expand(r["codes"]), off) if off[-1] else np.zeros(0, np.int64)
        yield r, Piece(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), unpack(r["set_id"], np.int64), codes, off, keys)


def sets_of(batch: pa.RecordBatch) -> Iterator[Piece]:
    """The sets of a batch of pieces."""
    return (p for _, p in _sets_of(batch))


def _lines_of(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each line of a packed piece: place in the order and key of its text, text, number and set."""
    row = np.cumsum(expand(r["row"]))
    return unpack(r["o"], np.int64)[row], unpack(r["text_key"], np.int64)[row], row, expand(r["number"]), expand(r["which"])


def _earliest(n_sets: int, which: np.ndarray, *order: np.ndarray) -> np.ndarray:
    """The first line of each set."""
    by = np.lexsort(order[::-1])[::-1]
    first = np.zeros(n_sets, np.int64)
    first[which[by]] = by
    return first


# --- prefix words ------------------------------------------------------------------------------


def prefixes(p: Piece, counts: np.ndarray, params: Params, chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The prefix words of those sets (all, or chosen) that can have a similar one: set, word, and place in the order of
    rarity. Words of about equal frequency go by hash."""
    chosen = np.arange(len(p.set_id)) if chosen is None else chosen
    n = p.n[chosen]
    chosen, n = chosen[n * (params.den - params.num) >= params.num], n[n * (params.den - params.num) >= params.num]  # smaller sets are only similar to equal ones
    order = np.argsort(np.round(np.log2(counts[_slot(p.keys, params.slots)] + 1.0) * 1024), kind="stable")
    rank = np.empty(len(order), np.uint64)
    rank[order] = np.arange(len(order), dtype=np.uint64)
    owner = np.repeat(np.arange(len(chosen), dtype=np.uint64), n)
    both = np.sort(owner << np.uint64(32) | rank[p.codes[ragged(p.off[chosen], n)]])
    length = n - -(-n * params.num // params.den) + 1
    taken = both[ragged(np.cumsum(n) - n, length)]
    return np.repeat(chosen, length), p.keys[order[(taken & LOW).astype(np.int64)]], ragged(np.zeros(len(n), np.int64), length)


def crowds(table: DataFrame, counts: np.ndarray, params: Params) -> np.ndarray:
    """How many prefix words fall into each slot."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(params.slots, np.int64)
        for batch in batches:
            for _, p in _sets_of(batch):
                total += np.bincount(_slot(prefixes(p, counts, params)[1], params.slots), minlength=params.slots)
        yield from sliced(np.minimum(total, 2**32 - 1))

    return added(table.mapInArrow(count, SLICED), params.slots)


def hot_words(table: DataFrame, counts: np.ndarray, crowd: np.ndarray, params: Params) -> tuple[np.ndarray, np.ndarray]:
    """The prefix words that more sets have than a block holds, sorted, and their blocks: 1 + sets // block.

    Only words of crowded slots are counted one by one; those that are hot are fewer than all prefix words / block.
    """
    crowded = crowd > params.block
    if not crowded.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, p in _sets_of(batch):
                word = prefixes(p, counts, params)[1]
                word, n = np.unique(word[crowded[_slot(word, params.slots)]], return_counts=True)
                if len(word):
                    yield pa.record_batch([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    hot = table.mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") > params.block).orderBy("word").collect()
    return np.array([r["word"] for r in hot], np.int64).view(np.uint64), 1 + np.array([r["n"] for r in hot], np.int64) // params.block


#: The prefix words of the sets of one piece that fall into one bucket: part of the word's hash (as differences), set id, sketch, place of
#: the set's first line (differences to the least in the order, line number), size, and position of the word; ``wide``: the further
#: sketch words, one for sets of a middle size and three for the large. ``words``: the whole sets, where asked for.
ENTRIES = "bucket int, word binary, set_id binary, sketch binary, least bigint, o binary, number binary, n binary, pos binary, wide binary, words binary"
WIDE = 3


def sketches(p: Piece, params: Params) -> tuple[np.ndarray, np.ndarray]:
    """The parity sketch of each set, and what is known of its parts (0 for smaller sets): of two parts, by the lowest bit, the second;
    for the large sets also the first two of four parts. The others follow, as the parts of one level make those of the level above."""
    bit = (np.uint64(1) << (p.keys & np.uint64(63)))[p.codes]
    sketch = np.bitwise_xor.reduceat(bit, p.off[:-1]) if len(bit) else np.zeros(0, np.uint64)
    wide = np.zeros((WIDE, len(sketch)), np.uint64)
    large = np.flatnonzero(p.n >= params.wide)
    if len(large):
        at = ragged(p.off[large], p.n[large])
        begin = np.cumsum(p.n[large]) - p.n[large]
        part, bit = (p.keys >> np.uint64(6) & np.uint64(3))[p.codes[at]], bit[at]
        for k, mine in enumerate((part & np.uint64(1) == 1, part == 0, part == 1)):
            wide[k, large] = np.bitwise_xor.reduceat(np.where(mine, bit, np.uint64(0)), begin)
        wide[1:, p.n < 2 * params.wide] = 0
    return sketch, wide


def entries(table: DataFrame, counts: np.ndarray, hot: tuple[np.ndarray, np.ndarray], buckets: int, params: Params, only: Filter | None = None) -> DataFrame:
    """The prefix words of all sets, or those that pass ``only``, with the whole sets. Hot words go to pairs of blocks, all others to one."""
    hot_word, hot_blocks = np.append(hot[0], np.uint64(2**64 - 1)), np.append(hot[1], 1)  # the last stands for none

    def rows(r: dict, p: Piece) -> Iterator[tuple]:
        chosen = None
        if only is not None:  # sets with such a word among all of theirs
            known = only.has(p.keys)[p.codes]
            chosen = np.flatnonzero(np.add.reduceat(known, p.off[:-1]) > 0) if len(known) else np.zeros(0, np.int64)
        j, word, pos = prefixes(p, counts, params, chosen)
        if only is not None:
            mine = only.has(word)
            j, word, pos = j[mine], word[mine], pos[mine]
        if not len(j):
            return
        o, _, _, number, which = _lines_of(r)
        first = _earliest(len(p.set_id), which, o, number)
        sketch, wide = sketches(p, params)
        place = np.searchsorted(hot_word, word)
        blocks = np.where(hot_word[place] == word, hot_blocks[place], 1)
        # What is in block b of B goes to the pairs of b and each other block, or to itself if B is 1.
        copies = np.maximum(blocks - 1, 1)
        own = np.repeat(mixed(p.set_id[j].view(np.uint64)) % blocks.astype(np.uint64), copies).astype(np.int64)
        other = ragged(np.zeros(len(copies), np.int64), copies)
        other = np.where(np.repeat(blocks, copies) == 1, 0, other + (other >= own))
        j, pos, word = np.repeat(j, copies), np.repeat(pos, copies), np.repeat(word, copies)
        pair = mixed(word + np.minimum(own, other).astype(np.uint64) * np.uint64(1_000_003) + np.maximum(own, other).astype(np.uint64))
        bucket = ((pair & LOW) * np.uint64(buckets)) >> np.uint64(32)
        order = np.argsort(bucket << np.uint64(32) | pair >> np.uint64(32))
        bucket, j, pos, short = bucket[order], j[order], pos[order], (pair >> np.uint64(32)).astype(np.uint32)[order]
        least = o.min()
        o, number = (o.view(np.uint64) - least.view(np.uint64))[first], number[first]
        for k in np.split(np.arange(len(j)), np.flatnonzero(runs(bucket))[1:]):
            s = j[k]
            far = wide[0, s[p.n[s] >= params.wide]].tobytes() + wide[1:, s[p.n[s] >= 2 * params.wide]].tobytes()
            whole = pack(p.words(s)[0]) if only is not None else b""
            yield (int(bucket[k[0]]), squeeze(np.diff(short[k], prepend=np.uint32(0))), p.set_id[s].tobytes(), sketch[s].tobytes(), int(least), squeeze(o[s]), squeeze(number[s]), squeeze(p.n[s]), squeeze(pos[k]), far, whole)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, p in _sets_of(batch):
                out = list(rows(r, p))
                if out:
                    yield _batch(out, ENTRIES)

    return table.mapInArrow(make, ENTRIES)


def _parts(words_: np.ndarray, n: np.ndarray, params: Params) -> np.ndarray:
    """The further sketch words of sets of these sizes, as :func:`sketches` gives them."""
    wide, far, further = np.zeros((WIDE, len(n)), np.uint64), n >= params.wide, n >= 2 * params.wide
    wide[0, far] = words_[: far.sum()]
    wide[1:, further] = words_[far.sum() :].reshape(WIDE - 1, -1)
    return wide


def _gathered(part: pa.Table, params: Params) -> dict[str, np.ndarray]:
    """The entries of a bucket whose word has several, by word and then by place, each set once per word; ``group``: the word's number."""
    rows = part.to_pylist()
    join = lambda f: np.concatenate([f(r) for r in rows])
    t = {
        "word": join(lambda r: np.cumsum(expand(r["word"]))),
        "set_id": join(lambda r: np.frombuffer(r["set_id"], np.int64)),
        "sketch": join(lambda r: np.frombuffer(r["sketch"], np.uint64)),
        "o": join(lambda r: expand(r["o"]) + r["least"]),
    }
    t |= {c: join(lambda r, c=c: expand(r[c])) for c in ("number", "n", "pos")}
    t["wide"] = np.concatenate([_parts(np.frombuffer(r["wide"], np.uint64), expand(r["n"]), params) for r in rows], axis=1)
    if rows[0]["words"]:
        t["words_at"] = np.cumsum(t["n"]) - t["n"]
    order = np.argsort(t["word"], kind="stable")
    word = t["word"][order]
    new = runs(word)
    size = np.diff(np.append(np.flatnonzero(new), len(word)))
    several = np.repeat(size > 1, size)
    order, group = order[several], np.cumsum(new)[several]
    place = np.lexsort((t["set_id"][order], t["number"][order], t["o"][order], group))
    order, group = order[place], group[place]
    key = mixed(t["set_id"][order].view(np.uint64)) + group.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + t["pos"][order].astype(np.uint64)
    _, one = np.unique(key, return_index=True)
    one = np.sort(one)
    order, group = order[one], group[one]
    return {c: v[..., order] for c, v in t.items()} | {"group": group}


def passes(t: dict[str, np.ndarray], a: np.ndarray, u: dict[str, np.ndarray], b: np.ndarray, params: Params) -> np.ndarray:
    """Which of the pairs (a of t, b of u) under one word may be similar: lengths, positions, and sketches."""
    na, nb = t["n"][a], u["n"][b]
    need = -(-params.num * (na + nb) // (params.num + params.den))
    left = np.minimum(na - t["pos"][a], nb - u["pos"][b])
    ok = np.flatnonzero((np.minimum(na, nb) * params.den >= np.maximum(na, nb) * params.num) & (left >= need) & (t["set_id"][a] != u["set_id"][b]))
    a, b, most = a[ok], b[ok], (na + nb - 2 * need)[ok]
    near = np.bitwise_count(t["sketch"][a] ^ u["sketch"][b]) <= most
    ok, a, b, most = ok[near], a[near], b[near], most[near]
    for level in (1, 2):
        large = np.flatnonzero(np.minimum(t["n"][a], u["n"][b]) >= level * params.wide)
        if len(large):
            whole = t["sketch"][a[large]] ^ u["sketch"][b[large]]
            odd, *quarters = (v[a[large]] ^ w[b[large]] for v, w in zip(t["wide"][: 2 * level - 1], u["wide"], strict=False))
            parts = [odd, whole ^ odd] if level == 1 else [*quarters, whole ^ odd ^ quarters[0], odd ^ quarters[1]]
            keep = np.ones(len(a), bool)
            keep[large] = sum(np.bitwise_count(w).astype(np.int64) for w in parts) <= most[large]
            ok, a, b, most = ok[keep], a[keep], b[keep], most[keep]
    return ok


def _windows(t: dict[str, np.ndarray], later: np.ndarray, done: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a, b) of places under one word, a before b, for the b in ``later``: with the first few a at first, then with
    more and more of them for the b that the caller has not marked as done. Some hundred thousand pairs at once."""
    new = runs(t["group"])
    begin = np.flatnonzero(new)[np.cumsum(new) - 1]
    before = np.arange(len(new)) - begin
    low = 0
    while len(later := later[~done[later] & (before[later] > low)]):
        high = low + width
        n = np.minimum(before[later], high) - low
        total = np.concatenate([[0], np.cumsum(n)])
        at = 0
        while at < len(later):
            end = max(at + 1, int(np.searchsorted(total, total[at] + 400_000, "right")) - 1)
            yield ragged(begin[later[at:end]] + low, n[at:end]), np.repeat(later[at:end], n[at:end])
            at = end
        low, width = high, 4 * width


def candidate_pairs(t: dict[str, np.ndarray], params: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(earlier, later) places under one word that pass all filters, until each later one has a few; and which later ones were not compared with all."""
    found = np.zeros(len(t["group"]), np.int64)
    done = np.zeros(len(found), bool)
    out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b in _windows(t, np.arange(len(found)), done, 2 * params.few):
        ok = passes(t, a, t, b, params)
        out_a.append(a[ok])
        out_b.append(b[ok])
        np.add.at(found, b[ok], 1)
        done |= found > params.few
    return np.concatenate(out_a), np.concatenate(out_b), done


OFFERS = "a bigint, b bigint, more boolean"


def places(new: np.ndarray) -> np.ndarray:
    """The place of each entry in its run; ``new``: where runs begin."""
    return np.arange(len(new)) - np.flatnonzero(new)[np.cumsum(new) - 1] if len(new) else np.zeros(0, np.int64)


def _offered(part: pa.Table, params: Params) -> pa.Table:
    """(a, b, more): sets a before b that pass the filters, the first few of each b (for whole texts also of each a), and whether b had more."""
    t = _gathered(part, params)
    a, b, more = candidate_pairs(t, params)
    sa, sb = t["set_id"][a], t["set_id"][b]
    more = more[b]
    # A pair may share several words: it counts once. Places are in order of the sets' lines under each word.
    order = np.lexsort((t["set_id"][a], t["number"][a], t["o"][a], sb))
    sa, sb, more, oa = sa[order], sb[order], more[order], np.lexsort((t["set_id"][b[order]], t["number"][b[order]], t["o"][b[order]], sa[order]))
    one = runs(sb) | runs(sa)
    many = np.unique(sb[more])
    rank = np.zeros(len(sa), np.int64)
    rank[one] = places(runs(sb[one]))
    keep = one & (rank < params.few)
    beyond = np.unique(sb[one & (rank >= params.few)])
    if params.shingle:
        back = np.zeros(len(sa), np.int64)
        first = oa[one[oa]]
        back[first] = places(runs(sa[first]))
        keep |= one & (back < params.few)
    sa, sb = sa[keep], sb[keep]
    return pa.table({"a": sa, "b": sb, "more": np.isin(sb, many) | np.isin(sb, beyond)})


def _verified(x: Words, y: Words, params: Params) -> np.ndarray:
    """Which of the pairs of sets are similar. Each side: the words of all sets, and where each pair's set begins and how many words it has."""
    out = [np.zeros(0, bool)]
    for k in range(0, len(x[1]), 4096):
        both = []
        for words_, begin, n in (x, y):
            at = ragged(begin[k : k + 4096], n[k : k + 4096])
            both.append(np.repeat(np.arange(len(n[k : k + 4096]), dtype=np.uint64), n[k : k + 4096]) << np.uint64(WORD_BITS) | words_[at])
        key = np.sort(np.concatenate(both))
        shared = np.bincount((key[1:][key[1:] == key[:-1]] >> np.uint64(WORD_BITS)).astype(np.int64), minlength=len(x[1][k : k + 4096]))
        out.append(params.den * shared >= params.num * (x[2][k : k + 4096] + y[2][k : k + 4096] - shared))
    return np.concatenate(out)


Words = tuple[np.ndarray, np.ndarray, np.ndarray]


def _searched(part: pa.Table, wanted: Filter, params: Params) -> pa.Table:
    """(a, b): for the sets b that are wanted an earlier similar set, if one shares this bucket's prefix words."""
    words_ = np.concatenate([unpack(v, np.uint64) for v in part.column("words").to_pylist()])
    t = _gathered(part, params)
    done = np.zeros(len(t["group"]), bool)
    out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b in _windows(t, np.flatnonzero(wanted.has(t["set_id"])), done, 2 * params.few):
        ok = passes(t, a, t, b, params)
        a, b = a[ok], b[ok]
        similar = _verified((words_, t["words_at"][a], t["n"][a]), (words_, t["words_at"][b], t["n"][b]), params)
        out_a.append(t["set_id"][a[similar]])
        out_b.append(t["set_id"][b[similar]])
        done[b[similar]] = True
    return pa.table({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})


# --- verification ------------------------------------------------------------------------------


def set_words(table: DataFrame, wanted: Filter) -> DataFrame:
    """(set_id, words): the word hashes of the sets that pass the filter."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, p in _sets_of(batch):
                mine = np.flatnonzero(wanted.has(p.set_id))
                values, n = p.words(mine)
                yield pa.record_batch([pa.array(p.set_id[mine]), pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(values.view(np.int64)))], names=["set_id", "words"])

    return table.mapInArrow(make, "set_id bigint, words array<bigint>").dropDuplicates(["set_id"])


def prefix_filter(table: DataFrame, counts: np.ndarray, wanted: Filter, params: Params) -> Filter:
    """The prefix words of the sets that pass ``wanted``."""
    from siftspark.session import checkpointed

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, p in _sets_of(batch):
                mine = np.flatnonzero(wanted.has(p.set_id))
                if len(mine):
                    yield pa.record_batch([pa.array(np.unique(prefixes(p, counts, params, mine)[1]).view(np.int64))], names=["word"])

    return filter_of(checkpointed(table.mapInArrow(make, "word bigint").distinct()))


def _search_few(table: DataFrame, rows: list, counts: np.ndarray, params: Params) -> DataFrame:
    """(a, b): for the sets b in ``rows`` (b, words, o, number) the earlier similar sets, one at least for each task that has some."""
    sizes = np.array([len(r["words"]) for r in rows], np.int64)
    keys, codes = np.unique(np.concatenate([np.array(r["words"], np.int64) for r in rows]).view(np.uint64), return_inverse=True)
    off = np.concatenate([[0], np.cumsum(sizes)])
    line = np.repeat(np.arange(len(rows), dtype=np.uint64), sizes)
    codes = (np.sort(line << np.uint64(32) | codes.astype(np.uint64)) & LOW).astype(np.int64)
    empty = np.zeros(0, np.int64)
    mine = Piece(empty, empty, empty, np.array([r["b"] for r in rows], np.int64), codes, off, keys)
    owner, word, pos = prefixes(mine, counts, params)
    order = np.argsort(word, kind="stable")
    owner, word = owner[order], word[order]
    sketch, wide = sketches(mine, params)
    u = {"set_id": mine.set_id[owner], "n": mine.n[owner], "pos": pos[order], "sketch": sketch[owner], "wide": wide[:, owner]}
    place = tuple(np.array([r[c] for r in rows], np.int64)[owner] for c in ("o", "number")) + (u["set_id"],)
    theirs = mine.words(np.arange(len(rows)))[0]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = np.zeros(len(rows), bool)
        for batch in batches:
            for r, p in _sets_of(batch):
                known = np.isin(p.keys, word)[p.codes]
                chosen = np.flatnonzero(np.add.reduceat(known, p.off[:-1]) > 0) if len(known) else empty
                j, w, at = prefixes(p, counts, params, chosen)
                lo = np.searchsorted(word, w, "left")
                n = np.searchsorted(word, w, "right") - lo
                if not n.any():
                    continue
                o, _, _, number, which = _lines_of(r)
                first = _earliest(len(p.set_id), which, o, number)
                sketch, wide = sketches(p, params)
                t = {"set_id": p.set_id[j], "n": p.n[j], "pos": at, "sketch": sketch[j], "wide": wide[:, j]}
                earlier = (o[first[j]], number[first[j]], t["set_id"])
                total = np.concatenate([[0], np.cumsum(n)])
                k = 0
                while k < len(n):
                    end = max(k + 1, int(np.searchsorted(total, total[k] + 400_000, "right")) - 1)
                    a, b = np.repeat(np.arange(k, end), n[k:end]), ragged(lo[k:end], n[k:end])
                    k = end
                    before = np.zeros(len(a), bool)
                    for x, y in zip(earlier[::-1], place[::-1], strict=True):
                        before = (x[a] < y[b]) | ((x[a] == y[b]) & before)
                    keep = before & ~done[owner[b]]
                    a, b = a[keep], b[keep]
                    ok = passes(t, a, u, b, params)
                    a, b = a[ok], b[ok]
                    similar = _verified((p.keys[p.codes], p.off[j[a]], t["n"][a]), (theirs, mine.off[owner[b]], u["n"][b]), params)
                    done[owner[b[similar]]] = True
                    if similar.any():
                        yield pa.record_batch([pa.array(t["set_id"][a[similar]]), pa.array(u["set_id"][b[similar]])], names=["a", "b"])

    return table.mapInArrow(search, "a bigint, b bigint")


def _with_places(table: DataFrame, wanted: Filter) -> DataFrame:
    """(set_id, o, number): the place of the first line of the sets that pass the filter."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = unpack(r["set_id"], np.int64)
                mine = np.flatnonzero(wanted.has(ids))
                o, _, _, number, which = _lines_of(r)
                first = _earliest(len(ids), which, o, number)[mine]
                yield pa.record_batch([pa.array(ids[mine]), pa.array(o[first]), pa.array(number[first])], names=["set_id", "o", "number"])

    places = table.mapInArrow(make, "set_id bigint, o bigint, number bigint")
    return places.groupBy("set_id").agg(F.min(F.struct("o", "number")).alias("_p")).select("set_id", "_p.*")


@dataclass(frozen=True)
class Links:
    """What the first candidates of all sets gave: the pieces, the frequencies of words, (a, b) similar sets, the words of these
    and other candidates, and (b) the sets that had more candidates."""

    table: DataFrame
    counts: np.ndarray
    hot: tuple[np.ndarray, np.ndarray]
    buckets: int
    links: DataFrame
    sets: DataFrame
    more: DataFrame


def verified_pairs(pairs: DataFrame, sets: DataFrame, params: Params) -> DataFrame:
    """Those of the candidates (a, b, ...) that are similar; the words of all are in ``sets`` (set_id, words)."""
    one, two = sets.select(F.col("set_id").alias("a"), F.col("words").alias("_wa")), sets.select(F.col("set_id").alias("b"), F.col("words").alias("_wb"))
    shared = F.size(F.array_intersect("_wa", "_wb"))
    similar = params.den * shared >= params.num * (F.size("_wa") + F.size("_wb") - shared)
    return pairs.join(one, "a").join(two, "b").filter(similar).select("a", "b")


def first_links(every: DataFrame, params: Params, extra: DataFrame | None = None) -> Links:
    """The similar sets among the first candidates, and which sets have more of them.

    ``extra``: candidates (a, b) that were found elsewhere, to be verified as well.
    """
    from siftspark.session import checkpointed

    table = every.filter("piece IS NOT NULL").drop("k", "v")
    counts = added(every.filter("piece IS NULL"), params.slots)
    crowd = crowds(table, counts, params)
    hot = hot_words(table, counts, crowd, params)
    buckets = max(16, int(crowd.sum(dtype=np.int64)) // params.bucket)
    pairs = entries(table, counts, hot, buckets, params).groupBy("bucket").applyInArrow(lambda part: _offered(part, params), OFFERS)
    if extra is not None:
        pairs = pairs.unionByName(extra.select("a", "b", F.lit(False).alias("more")))
    pairs = checkpointed(pairs.groupBy("a", "b").agg(F.bool_or("more").alias("more")))
    sets = checkpointed(set_words(table, filter_of(pairs.select(F.explode(F.array("a", "b")).alias("id")))))
    links = checkpointed(verified_pairs(pairs, sets, params))
    return Links(table, counts, hot, buckets, links, sets, pairs.filter("more").select("b").distinct())


def similar_sets(every: DataFrame, params: Params) -> DataFrame:
    """(a, b): similar sets that are not equal, a before b; each set to which an earlier one is similar is a b."""
    from siftspark.session import checkpointed

    x = first_links(every, params)
    left = checkpointed(x.more.join(x.links.select("b").distinct(), "b", "left_anti"))
    if not left.limit(1).count():
        return x.links
    wanted = filter_of(left)
    open_ = checkpointed(left.join(_with_places(x.table, wanted), F.col("b") == F.col("set_id")).join(x.sets, "set_id").select("b", "words", "o", "number"))
    if open_.agg(F.sum(F.size("words"))).first()[0] <= params.broadcast:
        return checkpointed(x.links.union(_search_few(x.table, open_.collect(), x.counts, params)).distinct())
    search = entries(x.table, x.counts, x.hot, x.buckets, params, prefix_filter(x.table, x.counts, wanted, params))
    hits = search.groupBy("bucket").applyInArrow(lambda part: _searched(part, wanted, params), "a bigint, b bigint")
    return checkpointed(x.links.union(hits).distinct())


# --- what goes ---------------------------------------------------------------------------------

#: Of the sets of one piece in one bucket: ids, and the place of the first line of each; rows with a null piece have the ids of sets that go.
#: Half of the text key is enough: it only parts the rows of one doc_id.
FIRSTS = "bucket int, piece bigint, set_id binary, o binary, number binary, text_key binary"
#: Of each of these sets whether no line stays (0), or only the first place in this piece (1).
VERDICTS = "piece bigint, bucket int, stays binary"


def _bucket_of(set_id: np.ndarray, buckets: int) -> np.ndarray:
    return ((mixed(set_id.view(np.uint64)) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _dealt(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that occurs, and the places of what is in it, in order."""
    order = np.argsort(bucket, kind="stable")
    if len(order):
        yield from ((int(bucket[k[0]]), k) for k in np.split(order, np.flatnonzero(runs(bucket[order]))[1:]))


def _judged(part: pa.Table) -> pa.Table:
    """The verdicts on a bucket's sets, for each piece that has some of them."""
    rows = part.to_pylist()
    gone = np.concatenate([np.zeros(0, np.int64), *(unpack(r["set_id"], np.int64) for r in rows if r["piece"] is None)])
    mine = [r for r in rows if r["piece"] is not None]
    if not mine:
        return _table([], VERDICTS)
    parts = [[unpack(r[c], np.int32 if c == "text_key" else np.int64) for c in ("set_id", "o", "number", "text_key")] for r in mine]
    ids, *place = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((*place[::-1], ids))
    new = runs(ids[order])
    first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    stays = np.empty(len(ids), bool)
    stays[order] = np.all([p[order] == p[first] for p in place], axis=0)
    stays &= ~np.isin(ids, gone)
    ends = np.cumsum([len(p[0]) for p in parts])[:-1]
    return _table([(r["piece"], r["bucket"], squeeze(s.astype(np.uint8))) for r, s in zip(mine, np.split(stays, ends), strict=True)], VERDICTS)


def removed_lines(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """(_o, _key, removed): line numbers, counted from 0, of the texts that lose a line, from (_o, text).

    Each piece sends the place of the first line of each of its sets to the bucket that owns the set, and
    learns which sets go and which of its lines come first; so a line that very many texts have costs one
    entry for each piece.
    """
    every = piece_table(docs.select("_o", "text", text_key().alias("text_key")), params)
    links = similar_sets(every, params)
    slim = every.filter("piece IS NOT NULL").select("piece", "o", "text_key", "row", "number", "which", "set_id")
    buckets = max(16, slim.count() // 8)

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = unpack(r["set_id"], np.int64)
                o, key, _, number, which = _lines_of(r)
                at = _earliest(len(ids), which, o, number, key)
                yield _batch([(b, r["piece"], *(pack(x) for x in (ids[k], o[at[k]], number[at[k]], (key[at[k]] >> 32).astype(np.int32)))) for b, k in _dealt(_bucket_of(ids, buckets))], FIRSTS)

    def going(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("b").to_numpy(zero_copy_only=False)
            yield _batch([(b, None, pack(ids[k]), None, None, None) for b, k in _dealt(_bucket_of(ids, buckets))], FIRSTS)

    def lost(part: pa.Table) -> pa.Table:
        rows = part.to_pylist()
        r = next(x for x in rows if x["stays"] is None)
        ids = unpack(r["set_id"], np.int64)
        o, key, row, number, which = _lines_of(r)
        at = _earliest(len(ids), which, o, number, key)
        stays = np.zeros(len(ids), bool)
        verdicts = {x["bucket"]: x["stays"] for x in rows if x["stays"] is not None}
        for b, k in _dealt(_bucket_of(ids, buckets)):
            stays[k] = expand(verdicts[b]) > 0
        first = at[which]
        gone = np.flatnonzero(~(stays[which] & (o == o[first]) & (number == number[first]) & (key == key[first])))
        gone = gone[np.lexsort((number[gone], row[gone]))]
        texts = np.flatnonzero(runs(row[gone]))
        off = pa.array(np.append(texts, len(gone)).astype(np.int32))
        return pa.table({"_o": o[gone[texts]], "_key": key[gone[texts]], "removed": pa.ListArray.from_arrays(off, pa.array(number[gone].astype(np.int32)))})

    judged = slim.mapInArrow(firsts, FIRSTS).unionByName(links.select("b").distinct().mapInArrow(going, FIRSTS)).groupBy("bucket").applyInArrow(_judged, VERDICTS)
    return slim.unionByName(judged, allowMissingColumns=True).groupBy("piece").applyInArrow(lost, "_o bigint, _key bigint, removed array<int>").dropDuplicates(["_o", "_key"])


def text_key(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def line_verdicts(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per document: its lines, and the numbers of those that go."""
    texts = with_order(docs.select("doc_id", "text"), order_table(docs))
    gone = removed_lines(texts, params)
    base = texts.select("doc_id", "_o", text_key().alias("_key"), F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("n_lines"))
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return base.join(gone, ["_o", "_key"], "left").select("doc_id", "n_lines", F.size(removed).alias("n_removed"), removed.alias("removed"))


def drop_lines(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """The documents, with all their columns, without the lines that go; a document that loses all its words goes."""
    ids = order_table(docs)
    gone = removed_lines(with_order(docs.select("doc_id", "text"), ids), params)
    row = with_order(docs.select(F.struct("*").alias("_row"), F.col("doc_id"), text_key().alias("_key")), ids)
    joined = row.join(gone, ["_o", "_key"], "left")
    lines = F.split(F.col("_row.text"), "\n", -1)
    # Rows that lose nothing keep their text as it is, null included.
    left = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("removed", i)), "\n")
    text = F.when(F.col("removed").isNull(), F.col("_row.text")).otherwise(left)
    kept = joined.withColumn("_text", text).filter(F.col("removed").isNull() | F.col("_text").rlike("[^\\x20\\x09-\\x0D]"))
    return kept.select(*[F.col("_text").alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])
