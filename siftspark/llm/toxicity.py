"""Toxicity by a weighted lexicon.

Texts are folded first: case, accents, look-alike letters of other scripts and
digits written for letters. An Aho-Corasick automaton finds the terms of the
lexicon in one pass over the whole folded text; a term inside an exception
phrase does not count. The lexicon is a list of known terms and, for languages
and slang that no list has, the words that a bounded sample of labelled texts
shows to mark toxic ones. Labels give each term its weight, the log-odds of
the label where the term occurs. The sum of weights, by itself and normalised
by length, goes through a logistic curve that is fitted on the labelled rows.

Defined results: null and empty texts have no terms and get the score of the
base rate without terms. Where the labels are all of one class or missing, the
terms keep their prior weight and the curve its prior shape. Repeated rows are
scored alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import unicodedata
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.llm.labelled import held_out, labels_by_document
from siftspark.llm.tokens import pieces
from siftspark.session import find_package

#: Insults, profanity and threats; one weight each is learned.
TERMS = (
    "idiot idiotic moron moronic stupid dumb dumbass imbecile cretin dimwit halfwit nitwit dunce fool foolish buffoon "
    "clown loser failure worthless pathetic disgusting disgrace revolting repulsive vile filthy filth scum scumbag trash "
    "garbage vermin parasite cockroach maggot rat pig swine dog bitch bastard whore slut tramp hag creep creepy pervert "
    "freak weirdo psycho lunatic maniac retard retarded cripple coward spineless liar cheat thief crook fraud traitor "
    "shit shitty bullshit crap piss fuck fucking fucker motherfucker asshole arse arsehole jackass dick dickhead prick "
    "cunt twat wanker bugger bollocks damn damned goddamn hell bloody hate hateful despise loathe kill murder die "
    "strangle rape hang shoot stab burn suffer rot subhuman savage barbarian degenerate inferior ugly fat hideous "
    "useless brainless clueless ignorant shameful shut kys"
).split()
#: Weak terms: common words that are toxic only in company; their prior weight is small.
WEAK = frozenset("fool foolish failure rat pig dog hag tramp cheat thief fraud hell bloody hate kill murder die hang shoot stab burn suffer rot savage inferior ugly fat shut cripple coward liar damn trash garbage".split())
EXCEPTIONS = (
    "trash can", "trash cans", "trash bin", "trash bins", "trash bag", "trash bags", "trash talk", "take out the trash", "garbage can", "garbage collector",
    "garbage collection", "garbage truck", "garbage bag", "clown fish", "circus clown", "clown shoes", "idiot proof", "foolproof", "dumb bell", "dumb waiter",
    "pond scum", "soap scum", "scum line", "hot dog", "guide dog", "guinea pig", "lab rat", "rat race", "pig iron", "bloody mary",
    "kill switch", "kill time", "kill process", "die cast", "tool and die", "burn rate", "burn cd", "hang out", "hang on", "shoot a film",
    "photo shoot", "stab wound", "system failure", "heart failure", "power failure", "fraud detection", "fraud prevention", "moby dick", "dick van dyke", "fat content",
    "low fat", "saturated fat", "shut down", "shut off", "shut up shop", "hell bent", "rot13", "cheat sheet", "pathetic fallacy", "stupid simple",
)
#: Letters that look like Latin ones, by code point of the Cyrillic, Greek or other letter.
LOOKALIKES = dict(zip("аеорсухкмтвніїјѕԁɡһβαεικνορτυχωℓı", "aeopcyxkmtbhiijsdghbaeikvoptuxwli", strict=True))
#: Digits and signs written for letters. l, 1 and i share one shape, so both text and lexicon fold to i.
SHAPES = dict(zip("0134578l", "oieastbi", strict=True))
SIGNS = {"@": "a", "$": "s"}


@dataclass(frozen=True)
class Params:
    threshold: float = 0.7
    folds: int = 3
    held_out_fold: int = 1
    prior_weight: float = 2.0
    weak_weight: float = 0.7
    #: Documents that the prior weight of a term counts for.
    prior_documents: float = 4.0
    ridge: float = 1e-3
    #: Labelled training texts of each class, in expectation, that terms are learned from.
    max_training: int = 20_000
    #: A learned term must occur in so many toxic texts, after so many different words.
    least_documents: int = 6
    least_contexts: int = 5
    least_log_odds: float = 1.5


class _Fold(dict):
    """Code point to folded letter, or to a space for all that is no letter."""

    def __missing__(self, code: int) -> str:
        c = unicodedata.normalize("NFKD", chr(code)).lower()[:1]
        c = LOOKALIKES.get(c, c)
        c = SHAPES.get(c, c)
        self[code] = c = c if c.isalpha() else " "
        return c


_FOLD = _Fold()


def folded(text: str) -> str:
    """Lower-case letters and single spaces for everything else; one character for one."""
    for sign, letter in SIGNS.items():
        if sign in text:  # a sign counts as a letter only before a letter
            parts = text.split(sign)
            text = parts[0] + "".join((letter if p[:1].isalpha() else " ") + p for p in parts[1:])
    return text.translate(_FOLD)


def automaton(terms: list[str], exceptions: tuple[str, ...] = EXCEPTIONS) -> ahocorasick.Automaton:
    """Whole-word patterns: (term number, length); exceptions have the number -1."""
    found = ahocorasick.Automaton()
    for phrase in exceptions:
        found.add_word(f" {folded(phrase)} ", (-1, len(phrase) + 2))
    for k, term in enumerate(terms):
        for form in (term, term + "s", term + "es"):
            if (key := f" {folded(form)} ") not in found:
                found.add_word(key, (k, len(key)))
    found.make_automaton()
    return found


def matches(text: str, found: ahocorasick.Automaton) -> dict[int, int]:
    """Term number to occurrences outside exception phrases."""
    hits = [(end - n + 1, end, k) for end, (k, n) in found.iter(f" {folded(text)} ")]
    if not hits:
        return {}
    excused = sorted((a, b) for a, b, k in hits if k < 0)
    starts, reach = [a for a, _ in excused], list(accumulate((b for _, b in excused), max))
    counts: dict[int, int] = {}
    for a, b, k in hits:
        # Of the phrases that begin no later, the one that goes furthest decides.
        before = bisect_right(starts, a)
        if k >= 0 and not (before and b <= reach[before - 1]):
            counts[k] = counts.get(k, 0) + 1
    return counts


def learned_terms(docs: DataFrame, labels: DataFrame, params: Params) -> list[str]:
    """Words that mark toxic texts, from a bounded sample of labelled training texts.

    A word qualifies by the lower bound of its log-odds; all that do are taken, and the sample bounds
    their number. Contexts are counted by the word before, so that a passage copied many times does not qualify.
    """
    from siftspark.session import checkpointed

    training = labels_by_document(labels, "toxic").filter(~held_out(F.col("doc_id"), params.folds, params.held_out_fold))
    sizes = {r["_label"]: r["n"] for r in training.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return []
    share = F.when(F.col("_label") == 1, params.max_training / sizes[1]).otherwise(params.max_training / sizes[0])
    sample = training.filter(F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(2**53)) / F.lit(float(2**53)) < share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[int]] = {}
        texts = [0, 0]
        for batch in pieces(batches):
            for text, label in zip(batch.column("text").to_pylist(), batch.column("_label").to_pylist(), strict=True):
                texts[label] += 1
                seen: dict[str, int] = {}
                before = ""
                for word in folded(text or "").split():
                    seen[word] = seen.get(word, 0) | 1 << zlib.crc32(before.encode()) % 63
                    before = word
                for word, contexts in seen.items():
                    entry = found.setdefault(word, [0, 0, 0])
                    entry[label] += 1
                    entry[2] |= contexts if label else 0
            if len(found) > 200_000:
                yield _rows(found, texts)
                found, texts = {}, [0, 0]
        yield _rows(found, texts)

    def _rows(found: dict[str, list[int]], texts: list[int]) -> pa.RecordBatch:
        found[""] = [*texts, 0]  # all texts, under the word that no text has
        columns = [pa.array(list(found), pa.string()), *(pa.array([v[i] for v in found.values()], pa.int64()) for i in range(3))]
        return pa.record_batch(columns, names=["word", "good", "bad", "contexts"])

    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    words = chosen.select("text", "_label").mapInArrow(count, "word string, good bigint, bad bigint, contexts bigint")
    words = words.groupBy("word").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.bit_count(F.bit_or("contexts")).alias("contexts"))
    # Written, as the totals and the terms both come from it.
    frequent = checkpointed(words.filter((F.col("word") == "") | ((F.col("bad") >= params.least_documents) & (F.col("contexts") >= params.least_contexts))))
    total = frequent.filter("word = ''").select(F.col("good").alias("all_good"), F.col("bad").alias("all_bad"))
    bound = F.log((F.col("bad") / F.col("all_bad")) / ((F.col("good") + 0.5) / (F.col("all_good") + 1))) - 1.64 * F.sqrt(1 / F.col("bad") + 1 / (F.col("good") + 0.5))
    # The totals are one row.
    ranked = frequent.filter("word != ''").crossJoin(F.broadcast(total)).withColumn("bound", bound).filter(F.col("bound") >= params.least_log_odds)
    return [r["word"] for r in ranked.orderBy(F.desc("bound"), "word").collect()]


def term_counts(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, n_words, terms, counts) of each whole text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(terms)
        for batch in pieces(batches):
            n_words, which, times = [], [], []
            for text in batch.column("text").to_pylist():
                counts = matches(text, found) if text else {}
                n_words.append(len(text.split()) if text else 0)
                which.append(list(counts))
                times.append(list(counts.values()))
            yield pa.record_batch([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(which, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32()))], names=["doc_id", "n_words", "terms", "counts"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(count, f"doc_id {kind}, n_words bigint, terms array<int>, counts array<int>")


def term_weights(labelled: DataFrame, terms: list[str], params: Params) -> list[float]:
    """Smoothed log-odds of the label by term, against the base rate; one bounded row per term comes back."""
    base = {r["_label"]: r["n"] for r in labelled.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    good, bad = base.get(0, 0), base.get(1, 0)
    rows = labelled.select("_label", F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n"), F.sum("_label").alias("bad")).collect()
    seen = {r["term"]: (r["n"], r["bad"]) for r in rows}
    weights = []
    for k, term in enumerate(terms):
        prior = params.weak_weight if term in WEAK else params.prior_weight
        if not good or not bad:
            weights.append(prior)
            continue
        n, hits = seen.get(k, (0, 0))
        share = bad / (good + bad)
        # Pseudo-documents at the odds that the prior weight means.
        odds = share / (1 - share) * math.exp(prior)
        m = params.prior_documents
        weights.append(math.log((hits + m * odds / (1 + odds)) / (n - hits + m / (1 + odds)) / (share / (1 - share))))
    return weights


def _logs(total: float, n_words: int) -> tuple[float, float]:
    """The sum of weights by itself and per 100 words; both grow slowly."""
    return math.log1p(total), math.log1p(100 * total / max(n_words, 20))


def features(counts: DataFrame, weights: list[float], terms: list[str]) -> DataFrame:
    """Add _a and _b, the sum of weights by itself and by length (repeats of a term count less), and name the terms."""
    find_package(counts.sparkSession)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, names = [], [], []
            for which, times, n in zip(*(batch.column(c).to_pylist() for c in ("terms", "counts", "n_words")), strict=True):
                total = max(0.0, sum(weights[t] * (1 + math.log(k)) for t, k in zip(which, times, strict=True)))
                x, y = _logs(total, n)
                a.append(x)
                b.append(y)
                names.append([terms[t] for t in which])
            at = batch.schema.get_field_index("terms")
            batch = batch.set_column(at, "terms", pa.array(names, pa.list_(pa.string())))
            yield batch.append_column("_a", pa.array(a, pa.float64())).append_column("_b", pa.array(b, pa.float64()))

    schema = ", ".join(f"{k} {'array<string>' if k == 'terms' else v}" for k, v in counts.dtypes)
    return counts.mapInArrow(weigh, schema + ", _a double, _b double")


def fit_curve(rows: DataFrame, params: Params) -> list[float]:
    """Logistic coefficients (constant, sum, density) by Newton steps over sums of all training rows."""
    beta, prior = np.array([-3.0, 2.0, 1.0]), np.array([-3.0, 2.0, 1.0])
    x = [F.lit(1.0), F.col("_a"), F.col("_b")]
    from siftspark.session import checkpointed

    # Rows with equal features are counted together first; most have no term at all. All steps go over these counts.
    rows = checkpointed(rows.groupBy(F.round("_a", 3).alias("_a"), F.round("_b", 3).alias("_b"), "_label").agg(F.count("*").alias("_n")))
    for _ in range(12):
        p = 1 / (1 + F.exp(-sum(float(w) * v for w, v in zip(beta, x, strict=True))))
        sums = [F.sum(F.col("_n") * (F.col("_label") - p) * v) for v in x] + [F.sum(F.col("_n") * p * (1 - p) * x[i] * x[j]) for i in range(3) for j in range(i, 3)]
        got = [v or 0.0 for v in rows.agg(F.sum("_n"), *sums).first()]
        n = max(got[0], 1)
        gradient = np.array(got[1:4]) / n - params.ridge * (beta - prior)
        hessian = np.zeros((3, 3))
        hessian[np.triu_indices(3)] = np.array(got[4:]) / n
        hessian = hessian + np.triu(hessian, 1).T + params.ridge * np.eye(3)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        beta[1:] = np.maximum(beta[1:], 0.05)  # more toxic terms never lower a score
        if np.abs(step).max() < 1e-4:
            break
    return [float(b) for b in beta]


def toxicity_scores(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per document: held_out, score, predicted, the matched terms and their counts."""
    from siftspark.session import checkpointed

    find_package(docs.sparkSession)
    known = {folded(t) for t in TERMS}
    terms = [*dict.fromkeys(TERMS), *(t for t in learned_terms(docs, labels, params) if t not in known)]
    counts = checkpointed(term_counts(docs, terms).withColumn("held_out", held_out(F.col("doc_id"), params.folds, params.held_out_fold)))
    labelled = checkpointed(counts.filter(~F.col("held_out")).join(labels_by_document(labels, "toxic"), "doc_id").select("terms", "counts", "n_words", "_label"))
    weights = term_weights(labelled, terms, params)
    c = fit_curve(features(labelled, weights, terms).select("_a", "_b", "_label"), params)
    score = 1 / (1 + F.exp(-(F.lit(c[0]) + c[1] * F.col("_a") + c[2] * F.col("_b"))))
    return features(counts, weights, terms).withColumn("score", score).select(
        "doc_id",
        "held_out",
        "score",
        (F.col("score") >= params.threshold).cast("int").alias("predicted"),
        "terms",
        "counts",
    )
