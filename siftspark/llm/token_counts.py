"""Token counts of a byte-level byte-pair vocabulary, without tokens.

A text is cut at the vocabulary's added strings, which count one each, and the rest into chunks by the pattern of
byte-level vocabularies. Within a chunk, symbols start as single bytes in a linked list, and all adjacent pairs that
have a merge lie in a heap by rank and place. The lowest is popped and merged, which takes one symbol away and offers
up to two new pairs; pairs that are no longer adjacent are passed over. The count is the number of bytes less the
number of merges; no token is looked up or emitted.

The rules are read once from the vocabulary's file, on the driver, and sent to the tasks (about 1 MB). A chunk that occurs
again is not merged again as long as it is among the remembered ones, ``Params.remembered`` for each Python worker.

Code points that Python's Unicode tables do not know yet may be letters for one library and none for another, so texts
that hold such are cut into chunks by the tokenizer library itself.

Defined results: null text counts as empty and has no tokens. Each row is counted by itself, so repeated rows have equal
counts; rows with a null doc_id are counted, too. An empty table gives an empty result; other columns are ignored. A text
of over ``Params.long_text`` characters is cut chunk by chunk; one chunk is merged as a whole, in about 200 bytes
of memory for each of its bytes.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from siftspark.llm.tokens import pieces, texts_of
from siftspark.session import find_package

#: Fixed value: how byte-level vocabularies of this kind cut a text into chunks.
CHUNKS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class Params:
    limit: int = 512
    remembered: int = 400_000
    long_chunk: int = 64
    long_text: int = 4 << 20


def read_vocabulary(path: str) -> str:
    """The JSON text of a vocabulary file; raises for kinds that this module does not count."""
    text = Path(path).read_text(encoding="utf-8")
    found = json.loads(text)
    model, cut = found["model"], found["pre_tokenizer"] or {}
    known = model["type"] == "BPE" and not found["normalizer"] and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
    plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if not known or not plain or any(t[k] for t in found["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"{path}: only plain byte-level byte-pair vocabularies are counted")
    return text


def byte_letters() -> list[str]:
    """The letter that stands for each byte in such files: printable ones for themselves, the others from U+0100 on in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Merger:
    """The merge rules of a vocabulary. Symbols are numbers: the 256 bytes, then the outcome of each merge."""

    def __init__(self, merges: list) -> None:
        number = {letter: b for b, letter in enumerate(byte_letters())}
        self.rank: dict[int, int] = {}
        self.outcome: list[int] = []
        for k, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[number[left] << 32 | number[right]] = k
            self.outcome.append(number.setdefault(left + right, 256 + k))

    def count(self, chunk: bytes) -> int:
        """Symbols left when nothing can be merged."""
        n = len(chunk)
        symbol, after, before = list(chunk), list(range(1, n + 1)), list(range(-1, n - 1))
        rank, outcome, merges = self.rank, self.outcome, 0
        heap = [r << 32 | i for i in range(n - 1) if (r := rank.get(symbol[i] << 32 | symbol[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            low = heapq.heappop(heap)
            k, i = low >> 32, low & 0xFFFFFFFF
            j = after[i]
            if symbol[i] < 0 or j >= n or rank.get(symbol[i] << 32 | symbol[j]) != k:
                continue  # one of the two has been merged since
            symbol[i], symbol[j] = outcome[k], -1
            after[i] = end = after[j]
            merges += 1
            if end < n:
                before[end] = i
                if (r := rank.get(symbol[i] << 32 | symbol[end])) is not None:
                    heapq.heappush(heap, r << 32 | i)
            if (start := before[i]) >= 0 and (r := rank.get(symbol[start] << 32 | symbol[i])) is not None:
                heapq.heappush(heap, r << 32 | start)
        return n - merges


class Remembered(dict):
    """Counts by chunk. Asked for a new chunk, it merges it and remembers short ones, up to a number and then anew."""

    def __init__(self, merger: Merger, params: Params) -> None:
        super().__init__()
        self.merger, self.params = merger, params

    def __missing__(self, chunk: str) -> int:
        n = self.merger.count(chunk.encode())
        if len(chunk) <= self.params.long_chunk:
            if len(self) >= self.params.remembered:
                self.clear()
            self[chunk] = n
        return n


class Letters(dict):
    """Whether Python's Unicode tables know a character, looked up once for each."""

    def __missing__(self, letter: str) -> bool:
        self[letter] = unicodedata.category(letter) != "Cn"
        return self[letter]


class Counter:
    """Counts the tokens of texts."""

    def __init__(self, vocabulary: str, params: Params) -> None:
        found = json.loads(vocabulary)
        added = sorted((t["content"] for t in found["added_tokens"]), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.counts, self.params = Remembered(Merger(found["model"]["merges"]), params), params
        self.chunks, self.known = regex.compile(CHUNKS), Letters()
        self.letter = {letter: b for b, letter in enumerate(byte_letters())}

    def count(self, text: str) -> int:
        parts = self.added.split(text) if self.added else [text]
        return len(parts) - 1 + sum(map(self._part, parts))

    def _part(self, text: str) -> int:
        if not text.isascii() and not all(map(self.known.__getitem__, set(text))):
            return sum(self.counts[bytes(map(self.letter.__getitem__, c)).decode()] for c in self._cut_by_library(text))
        if len(text) > self.params.long_text:
            return sum(self.counts[m.group()] for m in self.chunks.finditer(text))
        return sum(map(self.counts.__getitem__, self.chunks.findall(text)))

    @staticmethod
    def _cut_by_library(text: str) -> Iterator[str]:
        from tokenizers import pre_tokenizers

        return (chunk for chunk, _ in pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str(text))


@lru_cache(2)
def counter(vocabulary: str, params: Params) -> Counter:
    """One for each Python worker, kept from task to task."""
    return Counter(vocabulary, params)


def token_counts(docs: DataFrame, vocabulary: str, params: Params = Params()) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row; ``vocabulary`` is what :func:`read_vocabulary` returned."""
    find_package(docs.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary, params).count
        for batch in pieces(batches):
            texts = texts_of(batch)
            n = [count(t) for t in texts.to_pylist()]
            columns = [batch.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), pa.array(n, pa.int64()), pa.array([k > params.limit for k in n], pa.bool_())]
            yield pa.record_batch(columns, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(measure, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
