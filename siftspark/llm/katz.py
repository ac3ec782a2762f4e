"""Language-model scoring with a Katz backoff bigram model over words.

Tokens are the lower-cased words of a text and one end. P(word | before) is a
Katz model: bigram counts are discounted by Good-Turing, and what the discounts
free goes to the words not seen after ``before`` in proportion to their unigram
probability, by a weight that makes the sum over all words exactly one. The
unigram model adds one half to each known word's count and gives one half to
all words never seen in training. Words are compared by 64-bit hashes.

Tokens are not sent one by one. The texts are read once into a written table of
pieces: their distinct words, dealt to the buckets that own them, and the texts
as places among these. A bucket answers each piece with a number and a count for
each of its words. The piece then sends its distinct pairs, the number and count
of each pair's second word beside it, to the bucket that owns the word before; so
the table of pairs, partitioned by the word before, has all that the normaliser
of its contexts needs. The pairs of frequent contexts (over a quarter of a bucket's
tokens) are spread over all buckets, and their sums, at most three contexts for each
bucket, are broadcast. A pair that many texts of a piece have is asked for once and
its value is sent back to the piece, so that a common pair brings no list of all its texts
to one task.

Both the words and the pairs of a bucket or a piece are held in memory at once; ``piece`` and
``bucket`` are the bytes of text behind them, to be enlarged with the data, as there is a row
for each piece and bucket that have something in common.

Defined results: null text counts as empty and has one token, the end; without
training rows every word is unknown. Rows of equal doc_id and text are scored
alike; a null doc_id is a training row. An empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.llm.labelled import held_out
from siftspark.llm.tokens import expand, hashed, mixed, pack, pieces, ragged, runs, squeeze, texts_of, unpack, words
from siftspark.session import find_package

#: Stands for the end of a text among the word hashes.
END = np.uint64(0x5DEECE66D5DEECE6)
#: The number of what is before the first token; words have numbers from 1.
START = 0
#: Log-probabilities are added up as whole numbers of this part, so that the order of addition has no effect.
GRAIN = 1e-6


@dataclass(frozen=True)
class Params:
    """``most_discounted``: largest count that Good-Turing discounts; ``dense``: texts of a piece from which on a pair is asked for once."""

    folds: int = 5
    held_out_fold: int = 1
    most_discounted: int = 5
    dense: int = 32
    piece: int = 8 << 20
    bucket: int = 12 << 20


# --- rows --------------------------------------------------------------------------------------

#: A row holds the words of one piece that one bucket owns: sorted keys (as differences) and how often training texts have
#: them. A row with a null bucket holds the texts of a piece: their ids, the place of each token among the piece's words by key, token counts,
#: and whether a text is for training.
WORDS = "bucket int, chunk bigint, keys binary, train binary, ids binary, tokens binary, n_tokens binary, training binary"
#: The answer to a piece: number and count of each of its words that the bucket owns, and which of them are frequent contexts; or the texts.
KNOWN = "chunk bigint, bucket int, number binary, n binary, hot binary, ids binary, tokens binary, n_tokens binary, training binary"
#: The pairs of one piece in one bucket, sorted by the word before: its number (as differences), number and training count of the second word,
#: how often training texts have the pair, how many texts have it, these texts, and how often each has it; for dense pairs no texts follow.
#: ``hot``: 1 for pairs of frequent contexts, 0 for others, null for the texts of a piece: ids, token counts, known tokens, unigram sums,
#: and of the dense pairs, in order of buckets, the number of texts, the texts, and how often each has them.
PAIRS = "bucket int, chunk bigint, hot int, before binary, word binary, unigram binary, train binary, per binary, texts binary, times binary"
#: Sums of texts, or values of dense pairs, on their way back to the piece; or the texts.
SUMS = "chunk bigint, bucket int, hot int, texts binary, sums binary, values binary, ids binary, n_tokens binary, known binary, numerators binary, per binary, dense_texts binary, times binary, weight double, total bigint"
_KINDS = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "double": pa.float64()}


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.record_batch([pa.array([r.get(n) for r in rows], _KINDS[k]) for n, k in fields], names=[n for n, _ in fields])


def _table(rows: list[dict], schema: str) -> pa.Table:
    return pa.Table.from_batches([_batch(rows, schema)])


def _ids(column: pa.Array) -> bytes:
    """Document ids of any type."""
    sink = pa.BufferOutputStream()
    batch = pa.record_batch([column], names=["doc_id"])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the keys."""
    return ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _dealt(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that occurs, in order, and the places of what is in it, in order."""
    order = np.argsort(bucket, kind="stable")
    if len(order):
        yield from ((int(bucket[k[0]]), k) for k in np.split(order, np.flatnonzero(runs(bucket[order]))[1:]))


# --- pieces and words --------------------------------------------------------------------------


def word_table(docs: DataFrame, buckets: int, params: Params) -> DataFrame:
    """The written pieces of texts (doc_id, held_out, text)."""
    from pyspark import TaskContext

    from siftspark.session import checkpointed

    def rows(batch: pa.RecordBatch, chunk: int) -> list[dict]:
        training = ~batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        flat, off = words(texts_of(batch))
        n = np.diff(off)
        coded = flat.dictionary_encode()
        keys, place = np.unique(mixed(np.append(hashed(coded.dictionary), END)), return_inverse=True)
        tokens = np.full(len(flat) + len(n), place[-1])
        tokens[np.arange(len(flat)) + np.repeat(np.arange(len(n)), n)] = place[coded.indices.to_numpy()]
        train = np.bincount(tokens, np.repeat(training, n + 1), len(keys)).astype(np.int64)
        out: list[dict] = [{"bucket": b, "chunk": chunk, "keys": squeeze(np.diff(keys[k], prepend=np.uint64(0))), "train": squeeze(train[k])} for b, k in _dealt(_bucket_of(keys, buckets))]
        return [*out, {"chunk": chunk, "ids": _ids(batch.column("doc_id")), "tokens": squeeze(tokens), "n_tokens": squeeze(n + 1), "training": squeeze(training.astype(np.uint8))}]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in pieces(batches, limit=params.piece):
            for at in range(0, batch.num_rows, 1 << 16):
                yield _batch(rows(batch.slice(at, 1 << 16), chunk), WORDS)
                chunk += 1

    return checkpointed(docs.select("doc_id", "held_out", "text").mapInArrow(make, WORDS))


def answered(table: DataFrame, buckets: int) -> DataFrame:
    """The pieces' texts, and the numbers and counts of their words. Frequent words get small numbers, which are b + 1 modulo the buckets."""

    def answer(part: pa.Table) -> pa.Table:
        rows = part.to_pylist()
        keys = [np.cumsum(expand(r["keys"]).view(np.uint64), dtype=np.uint64) for r in rows]
        distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.bincount(where, np.concatenate([expand(r["train"]) for r in rows]), len(distinct)).astype(np.int64)
        number = np.empty(len(distinct), np.int64)
        number[np.argsort(-counts, kind="stable")] = np.arange(len(distinct)) * buckets + rows[0]["bucket"] + 1
        hot = 4 * counts > counts.sum()
        out = []
        for r, k in zip(rows, np.split(where, np.cumsum([len(x) for x in keys])[:-1]), strict=True):
            out.append({"chunk": r["chunk"], "bucket": r["bucket"], "number": squeeze(number[k]), "n": squeeze(counts[k]), "hot": squeeze(np.flatnonzero(hot[k]))})
        return _table(out, KNOWN)

    known = table.filter("bucket IS NOT NULL").select("bucket", "chunk", "keys", "train").groupBy("bucket").applyInArrow(answer, KNOWN)
    return table.filter("bucket IS NULL").select("chunk", "ids", "tokens", "n_tokens", "training").unionByName(known, allowMissingColumns=True)


# --- pairs -------------------------------------------------------------------------------------


def pair_table(known: DataFrame, buckets: int, params: Params) -> DataFrame:
    """The pairs of all pieces, partitioned by the bucket of the word before."""

    def make(part: pa.Table) -> pa.Table:
        rows = part.to_pylist()
        head = next(r for r in rows if r["bucket"] is None)
        answers = sorted((r for r in rows if r["bucket"] is not None), key=lambda r: r["bucket"])
        number, counts = (np.concatenate([expand(r[c]) for r in answers]) for c in ("number", "n"))
        begin = np.cumsum([0, *(len(expand(r["n"])) for r in answers)])
        hot = np.zeros(len(number), bool)
        hot[np.concatenate([a + expand(r["hot"]) for a, r in zip(begin, answers, strict=False)])] = True
        tokens, n_tokens, training = expand(head["tokens"]), expand(head["n_tokens"]), expand(head["training"]).astype(bool)
        n_texts, size = len(n_tokens), len(number) + 1
        text = np.repeat(np.arange(n_texts), n_tokens)
        first = np.cumsum(n_tokens) - n_tokens
        sums = [np.bincount(text, v[tokens], n_texts) for v in ((counts > 0).astype(float), np.log10(counts + 0.5))]
        # A use is a pair of places in the list of words, to whose end the start of a text is added, and a text.
        before = np.concatenate([[0], tokens[:-1]])
        before[first] = size - 1
        uses = np.sort((before * size + tokens) * n_texts + text)
        new = np.flatnonzero(runs(uses))
        times = np.diff(np.append(new, len(uses)))
        pair, text_of = uses[new] // n_texts, uses[new] % n_texts
        begin = np.flatnonzero(runs(pair))
        per = np.diff(np.append(begin, len(pair)))
        train = np.add.reduceat(times * training[text_of], begin)
        x, y = pair[begin] // size, pair[begin] % size
        number, hot = np.append(number, START), np.append(hot, True)
        a, b, spread = number[x], number[y], hot[x]
        bucket = np.where(spread, _bucket_of(mixed(mixed(a.astype(np.uint64)) + b.astype(np.uint64)), buckets), (a - 1) % buckets)
        dense = per >= params.dense
        order = np.lexsort((a, dense, spread, bucket))
        out: list[dict] = []
        for k in np.split(order, np.flatnonzero(runs(bucket[order] * 2 + spread[order]))[1:]):
            use = ragged(begin[k], np.where(dense[k], 0, per[k]))
            step = np.diff(a[k], prepend=0)
            m = np.count_nonzero(~dense[k])
            if m < len(k):  # sorted anew for the dense ones
                step[m] = a[k][m]
            out.append({"bucket": int(bucket[k[0]]), "chunk": head["chunk"], "hot": int(spread[k[0]]), "before": squeeze(step), "word": squeeze(b[k]), "unigram": squeeze(counts[y[k]]), "train": squeeze(train[k]), "per": squeeze(np.where(dense[k], 0, per[k])), "texts": squeeze(text_of[use]), "times": squeeze(times[use])})
        k = order[dense[order]]
        use = ragged(begin[k], per[k])
        out.append({
            "bucket": int(head["chunk"] % buckets), "chunk": head["chunk"], "before": head["ids"], "word": head["n_tokens"], "unigram": squeeze(sums[0].astype(np.int64)),
            "train": pack(sums[1]), "per": squeeze(per[k]), "texts": squeeze(text_of[use]), "times": squeeze(times[use]),
        })
        return _table(out, PAIRS)

    return known.groupBy("chunk").applyInArrow(make, PAIRS).repartition("bucket")


@dataclass
class Bucket:
    """The distinct pairs of a bucket's rows of one kind: number of the word before, training counts of the second word and of the pair.
    ``where``: for each row, the place of its pairs among the distinct ones."""

    before: np.ndarray
    unigram: np.ndarray
    count: np.ndarray
    where: list[np.ndarray]


def _before(r: dict) -> np.ndarray:
    """Numbers of the words before, from the differences of two sorted stretches: pairs with texts, and dense ones."""
    step, m = expand(r["before"]), int(np.count_nonzero(expand(r["per"])))
    return np.concatenate([np.cumsum(step[:m]), np.cumsum(step[m:])])


def bucket_of(rows: list[dict]) -> Bucket:
    before, word, unigram, train = ([f(r) for r in rows] for f in (_before, *(lambda r, c=c: expand(r[c]) for c in ("word", "unigram", "train"))))
    ends = np.cumsum([len(b) for b in before])[:-1]
    a, b = np.concatenate(before), np.concatenate(word)
    _, first, where = np.unique(mixed(mixed(a.astype(np.uint64)) + b.astype(np.uint64)), return_index=True, return_inverse=True)
    return Bucket(a[first], np.concatenate(unigram)[first].astype(float), np.bincount(where, np.concatenate(train), len(first)), np.split(where, ends))


#: Sums over all pairs, by kind: numbers of pairs by training count (-1), training tokens (-2), known words (-3); else the number of a frequent
#: context, with the sum over its seen words of their counts and one half each (0), how many pairs are seen 1 .. most times, and the sum of the larger counts.
STATISTICS = "at bigint, c int, v double"


def pair_statistics(pairs: DataFrame, most: int) -> DataFrame:
    """One row (statistics): an array of the sums."""

    def gather(part: pa.Table) -> pa.Table:
        rows = [r for r in part.to_pylist() if r["hot"] is not None]
        out = []
        for hot in (0, 1):
            mine = [r for r in rows if r["hot"] == hot]
            if not mine:
                continue
            p = bucket_of(mine)
            c = p.count.astype(np.int64)
            out += [(-1, k, v) for k, v in enumerate(np.bincount(np.minimum(c, most + 2), minlength=most + 3).tolist())]
            out.append((-2, 0, int(c.sum())))
            seen = c > 0
            contexts, at = np.unique(p.before[seen], return_inverse=True)
            if hot:
                sums = np.zeros((len(contexts), most + 2))
                np.add.at(sums, (at, 0), p.unigram[seen] + 0.5)
                np.add.at(sums, (at, np.minimum(c[seen], most + 1)), np.where(c[seen] > most, c[seen], 1))
                out += [(int(contexts[i]), k, float(sums[i, k])) for i, k in zip(*map(np.ndarray.tolist, np.nonzero(sums)), strict=True)]
            else:
                out.append((-3, 0, len(contexts)))
        return pa.table({"at": pa.array([r[0] for r in out], pa.int64()), "c": pa.array([r[1] for r in out], pa.int32()), "v": pa.array([float(r[2]) for r in out], pa.float64())})

    sums = pairs.groupBy("bucket").applyInArrow(gather, STATISTICS).groupBy("at", "c").agg(F.sum("v").alias("v"))
    return sums.agg(F.collect_list(F.struct("at", "c", "v")).alias("statistics"))


def good_turing(of_count: np.ndarray, most: int) -> np.ndarray:
    """Discount by count 0..most from the numbers of pairs seen so often (of_count[c], c to most + 1).

    Katz's form, in which the freed mass is that of the pairs seen once; where the counts are too
    thin for it, an absolute discount.
    """
    n = of_count.astype(float)
    out = np.ones(most + 1)
    absolute = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    common = (most + 1) * n[most + 1] / n[1] if n[1] else 1.0
    for c in range(1, most + 1):
        d = ((c + 1) * n[c + 1] / (c * n[c]) - common) / (1 - common) if n[c] and common < 1 else -1.0
        out[c] = d if 0 < d < 1 else (c - min(absolute, 0.9)) / c
    return out


def discounted(c: np.ndarray, discount: np.ndarray) -> np.ndarray:
    small = c < len(discount)
    return np.where(small, c * discount[np.where(small, c, 0).astype(np.int64)], c)


class Katz:
    """P(word | before): ``p`` has the unigram probability of each word or pair, the last three arrays one entry for each context:
    its count, the sum of its discounted pair counts, and the sum of the probabilities of the words seen after it."""

    def __init__(self, p: np.ndarray, discount: np.ndarray, total: np.ndarray, kept: np.ndarray, lower: np.ndarray) -> None:
        self.p, self.discount, self.total = p, discount, total
        share = np.divide(kept, total, out=np.zeros_like(kept), where=total > 0)
        # What is left must be more than nothing where some word is unseen, and nothing where none is.
        unseen = np.where(total > 0, 1 - lower, 1.0)
        none = unseen < 1e-9
        self.scale = np.where(none & (share > 0), 1 / np.maximum(share, 1e-300), np.where(share > 1 - 1e-9, total / (total + 1), 1.0))
        self.backoff = np.where(none, 0.0, (1 - share * self.scale) / np.maximum(unseen, 1e-300))

    def probability(self, before: np.ndarray, place: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The discounted share where the pair is seen, else the unigram probability times the context's backoff weight."""
        seen = self.scale[before] * discounted(c, self.discount) / np.maximum(self.total[before], 1)
        return np.where(c > 0, seen, self.backoff[before] * self.p[place])


@dataclass
class Model:
    """What all buckets share: training tokens, the weight of all unigrams, discounts, and the sums of the frequent contexts (number, total, kept, lower)."""

    n: int
    weight: float
    discount: np.ndarray
    hot: np.ndarray
    hot_sums: np.ndarray

    @classmethod
    def of(cls, statistics: list[dict], most: int) -> Model:
        at = np.array([s["at"] for s in statistics], np.int64)
        c = np.array([s["c"] for s in statistics], np.int64)
        v = np.array([s["v"] for s in statistics])
        of_count = np.bincount(c[at == -1], v[at == -1], most + 3)
        discount = good_turing(of_count, most)
        hot, place = np.unique(at[at >= 0], return_inverse=True)
        sums = np.zeros((len(hot), most + 2))
        sums[place, c[at >= 0]] = v[at >= 0]
        # Each known word but the end is the word before in some pair.
        n = int(v[at == -2].sum())
        known = int(v[at == -3].sum()) + len(hot) - (START in hot) + (n > 0)
        weight = n + 0.5 * (known + 1)
        k = np.arange(1, most + 1)
        return cls(n, weight, discount, hot, np.stack([sums[:, 1:-1] @ k + sums[:, -1], sums[:, 1:-1] @ (k * discount[1:]) + sums[:, -1], sums[:, 0] / weight]))

    def log_probability(self, pairs: Bucket, hot: bool) -> np.ndarray:
        """log10 P of each pair, in grains."""
        p = (pairs.unigram + 0.5) / self.weight
        contexts, at = np.unique(pairs.before, return_inverse=True)
        if hot:
            place = np.minimum(np.searchsorted(self.hot, contexts), max(len(self.hot) - 1, 0))
            found = self.hot[place] == contexts if len(self.hot) else np.zeros(len(contexts), bool)
            sums = np.where(found, self.hot_sums[:, place] if len(self.hot) else 0.0, 0.0)
        else:
            seen = pairs.count > 0
            sums = np.stack([np.bincount(at, v * seen, len(contexts)) for v in (pairs.count, discounted(pairs.count, self.discount), p)])
        return np.rint(np.log10(Katz(p, self.discount, *sums).probability(at, np.arange(len(p)), pairs.count)) / GRAIN)


# --- scores ------------------------------------------------------------------------------------


def text_scores(pairs: DataFrame, statistics: DataFrame, kind: str, params: Params) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of each text."""

    def partial(part: pa.Table) -> pa.Table:
        model = Model.of(part.column("statistics")[0].as_py(), params.most_discounted)
        rows, out = part.drop_columns(["statistics"]).to_pylist(), []
        for hot in (0, 1):
            mine = [r for r in rows if r["hot"] == hot]
            if not mine:
                continue
            p = bucket_of(mine)
            values = model.log_probability(p, bool(hot))
            for r, at in zip(mine, p.where, strict=True):
                per, texts = expand(r["per"]), expand(r["texts"])
                seen, inverse = np.unique(texts, return_inverse=True)
                sums = np.bincount(inverse, np.repeat(values[at], per) * expand(r["times"]), len(seen))
                out.append({"chunk": r["chunk"], "bucket": r["bucket"], "hot": hot, "texts": squeeze(seen), "sums": squeeze(-sums.astype(np.int64)), "values": squeeze(-values[at[per == 0]].astype(np.int64))})
        for r in rows:
            if r["hot"] is None:
                out.append({"chunk": r["chunk"], "ids": r["before"], "n_tokens": r["word"], "known": r["unigram"], "numerators": r["train"], "per": r["per"], "dense_texts": r["texts"], "times": r["times"], "weight": model.weight, "total": model.n})
        return _table(out, SUMS)

    def add(part: pa.Table) -> pa.Table:
        rows = part.to_pylist()
        head = next(r for r in rows if r["ids"] is not None)
        rows = sorted((r for r in rows if r["ids"] is None), key=lambda r: (r["bucket"], r["hot"]))
        n_tokens = expand(head["n_tokens"])
        total = np.zeros(len(n_tokens), np.int64)
        for r in rows:
            total[expand(r["texts"])] -= expand(r["sums"])
        values = np.concatenate([np.zeros(0, np.int64), *(expand(r["values"]) for r in rows)])
        np.subtract.at(total, expand(head["dense_texts"]), np.repeat(values, expand(head["per"])) * expand(head["times"]))
        base = unpack(head["numerators"], np.float64) - n_tokens * np.log10(head["weight"])
        ids = pa.ipc.open_stream(head["ids"]).read_all().column("doc_id")
        return pa.table({"doc_id": ids, "n_tokens": n_tokens, "n_known": expand(head["known"]), "train_tokens": np.full(len(n_tokens), head["total"]), "base_score": base, "score": total * GRAIN})

    scored = pairs.crossJoin(F.broadcast(statistics)).groupBy("bucket").applyInArrow(partial, SUMS)
    return scored.groupBy("chunk").applyInArrow(add, f"doc_id {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def language_scores(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per document: token counts, base_score (unigram) and score (Katz), both log10 of the text's probability."""
    find_package(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, -(-size // params.bucket))
    named = docs.select("doc_id", "text", held_out(F.col("doc_id"), params.folds, params.held_out_fold).alias("held_out"))
    pairs = pair_table(answered(word_table(named, buckets, params), buckets), buckets, params)
    scored = text_scores(pairs, pair_statistics(pairs, params.most_discounted), dict(docs.dtypes)["doc_id"], params)
    return scored.select("doc_id", held_out(F.col("doc_id"), params.folds, params.held_out_fold).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
