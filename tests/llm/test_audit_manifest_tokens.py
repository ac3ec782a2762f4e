"""The dataset manifest, the filter audit and the token counts against brute force."""

import random
from collections import Counter
from hashlib import sha256
from itertools import permutations

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siftspark.llm import filter_audit, merkle, token_counts
from siftspark.llm.queries import op11_merkle, op12_filter_audit, op13_token_counts

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row int, leaf0 string, part string, mask int, siblings string"
TAIL = (1, "x", "p", 7, "s")


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(row, text=None):
    values = [row.doc_id, row.source, row.lang, row.n_chars, row.text if text is None else text]
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, fanout):
    """All levels from below, and for each node its siblings (before, after) up to the top."""
    paths = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for p, i in enumerate(at):
            run = nodes[i // fanout * fanout : i // fanout * fanout + fanout]
            paths[p].append(("".join(run[: i % fanout]), "".join(run[i % fanout + 1 :])))
        nodes = [digest("".join(nodes[k : k + fanout])) for k in range(0, len(nodes), fanout)]
        at = [i // fanout for i in at]
    return nodes[0], paths


def plain_proofs(rows, fanout=16):
    """[(row, leaf, subroot, root, siblings)] in plain Python."""
    groups = {}
    for r in rows:
        groups.setdefault(r.source, []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        own = sorted(groups[g], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r)))
        trees[g] = own, *climb([leaf_of(r) for r in own], fanout)
    root, above = climb([trees[g][1] for g in names], fanout)
    return [(r, leaf_of(r), trees[g][1], root, path + above[k]) for k, g in enumerate(names) for r, path in zip(trees[g][0], trees[g][2])]


def doc_rows(spark, rows):
    return spark.createDataFrame([(*r, *TAIL) for r in rows], SCHEMA)


def shown(rows):
    return sorted((repr(r.doc_id), leaf, subroot, root, tuple(path)) for r, leaf, subroot, root, path in rows)


def some_docs():
    r = random.Random(3)
    rows = [(i, f"Text {i % 40} É", "en", r.choice(["hot"] * 3 + ["a", "b", "", None, "é"]), i) for i in range(400)]
    rows += [rows[5], rows[5], (None, "no id", None, "hot", None), (None, "no id", None, "hot", None), (None, None, None, None, None), (5, "other text", "en", rows[5][3], 1), (10**18, "", "de", "lone", 0)]
    return rows + [(k, "same", "en", f"group{k:03d}", 4) for k in range(-(2**63), -(2**63) + 60)]


@pytest.mark.parametrize("fanout, part_rows", [(16, 250_000), (16, 40), (2, 7), (3, 1)])
def test_proofs_are_those_of_plain_trees(spark, fanout, part_rows):
    docs = doc_rows(spark, some_docs())
    params = merkle.Params(fanout=fanout, part_rows=part_rows, slice_rows=11)
    carried = merkle.leaves(docs).select("doc_id", "source", "leaf", "_row", "siblings")
    got = merkle.proofs(carried, params=params).withColumn("folded", merkle.fold(F.col("_row.leaf"), F.col("siblings"))).collect()
    want = plain_proofs(docs.collect(), fanout)
    assert shown([(r["_row"], r["_row"]["leaf"], r["subroot"], r["root"], [(s["before"], s["after"]) for s in r["siblings"]]) for r in got]) == shown(want)
    assert all(r["folded"] == r["root"] and r["_row"]["_row"] == 1 and r["_row"]["siblings"] == "s" for r in got)
    sizes = Counter(r["_row"]["source"] for r in got)
    assert all(r["size"] == sizes[r["_row"]["source"]] and 0 <= r["position"] < r["size"] for r in got)


def test_subtrees_of_any_cut_meet():
    for size, fanout in [(1, 2), (5, 2), (16, 4), (37, 3), (100, 16), (257, 16)]:
        nodes = [digest(str(i)) for i in range(size)]
        for cut in range(1, size):
            left, right = merkle.Subtrees(nodes[:cut], 0, size, fanout), merkle.Subtrees(nodes[cut:], cut, size, fanout)
            ragged = {(level, i) for t in (left, right) for level, i, _ in t.ragged()}
            assert left.root is None and {(level + 1, i // fanout) for level, i in ragged} <= {*left.missing(), *right.missing()}
            assert len(ragged) <= 2 * fanout * len(left.levels)


def test_lone_rows_and_empty_tables(spark):
    one = merkle.leaves(doc_rows(spark, [(1, "A", "en", None, 1)]))
    (r,) = merkle.proofs(one.select("doc_id", "source", "leaf")).collect()
    assert r["siblings"] == [] and r["root"] == r["subroot"] == r["_row"]["leaf"]
    assert merkle.proofs(one.limit(0).select("doc_id", "source", "leaf")).count() == 0
    assert merkle.manifest(one.limit(0)).count() == 0


def test_manifests_say_which_groups_changed(spark):
    rows = some_docs()
    old = merkle.manifest(merkle.leaves(doc_rows(spark, rows)))
    want = {(r.source, subroot, root) for r, _, subroot, root, _ in plain_proofs(doc_rows(spark, rows).collect())}
    assert {(r["source"], r["subroot"], r["root"]) for r in old.collect()} == want
    new = [(i, t.upper() if i == 0 else t, la, s, n) for i, t, la, s, n in rows[:-30] if t is not None]
    got = {(r["source"], r["change"]) for r in merkle.changed_groups(old, merkle.manifest(merkle.leaves(doc_rows(spark, [*new, (7, "x", "en", "fresh", 1)])))).collect()}
    gone = {(r[3], "removed") for r in rows[-30:]}
    assert got == gone | {("fresh", "added"), (rows[0][3], "changed"), (None, "changed")}


def test_op11_on_the_given_table(spark):
    got = {r["doc_id"]: r for r in op11_merkle(spark, DATA).collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    import zlib

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for r, leaf, subroot, root, path in plain_proofs(docs):
        h = leaf if zlib.crc32(str(r.doc_id).encode()) % 5 else leaf_of(r, r.text.translate(lower))
        for before, after in path:
            h = digest(before + h + after)
        row = got[r.doc_id]
        proof = digest("".join(a + b for a, b in path))
        assert (row["leaf"], row["subroot"], row["root"], row["proof_sha256"], row["folded_root"], row["verified"]) == (leaf, subroot, root, proof, h, h == root)
    assert {r["verified"] for r in got.values()} == {True, False}


# --- audit ------------------------------------------------------------------------------------------


def plain_fails(rows):
    import re

    first = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    out = []
    for doc_id, text, _, source, *_ in rows:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": doc_id is not None and doc_id > first[text],
        }
        out.append((source or "", doc_id, {k for k, v in fails.items() if v}))
    return out


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    failed = plain_fails(rows)
    out = {}
    for part in {p for p, *_ in failed}:
        own = [(i, f) for p, i, f in failed if p == part]
        share = Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                here = [(i, f) for i, f in left if name in f]
                left = [(i, f) for i, f in left if name not in f]
                failing = sum(name in f for _, f in own)
                out[part, "".join(order), step] = [len(left), len(here), failing - len(here), sum(f == {name} for _, f in own), sum(i in good for i, _ in here), sum(i in toxic for i, _ in here)]
                share[name] += len(here)
        for (p, order, step), values in out.items():
            if p == part:
                values.append(share[order[step - 1]])
    return out


def audit_docs():
    prose = " ".join(f"word{i}" for i in range(60))
    texts = [None, "", prose, prose, prose.upper(), prose + " #", "word " * 80, "é" * 30 + " " + prose, "x" * 50_000, prose * 300, "A\n" * 60 + "|", "\x1c \x85 "]
    rows = [(i, t, "en", ["s1", "s2", None, ""][i % 4], i) for i, t in enumerate(texts * 4)]
    return rows + [rows[2], rows[2], rows[7], (None, prose, "en", "s1", 1), (None, "", "en", None, 1), (-(2**63), prose, "en", "s3", 1), (2**63 - 1, prose, "en", "s3", 1), (5, "not the first text of 5", "en", "s4", 1)]


AUDIT_LABELS = [*((i, i % 2, int(i % 7 == 0)) for i in range(0, 48, 3)), (None, 1, 1), (2**63 - 1, 1, 1), (3, 0, 1), (6, None, None), (6, 1, None), (9, 5, -1)]


def seen_audit(frame):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in frame.collect()}


def test_audit_is_that_of_applying_all_orders(spark):
    labels = spark.createDataFrame(AUDIT_LABELS, "doc_id bigint, quality int, toxic int")
    docs = doc_rows(spark, audit_docs())
    assert seen_audit(filter_audit.filter_audit(docs, labels)) == plain_audit(audit_docs(), AUDIT_LABELS)
    assert filter_audit.filter_audit(docs.limit(0), labels.limit(0)).count() == 0
    assert {tuple(v[4:6]) for v in seen_audit(filter_audit.filter_audit(docs, labels.limit(0))).values()} == {(0, 0)}


def test_op12_on_the_given_tables(spark):
    docs = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    got = seen_audit(op12_filter_audit(spark, DATA))
    assert got == plain_audit(docs, labels) and len(got) == 600 * len({d[3] for d in docs})


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 15), st.integers(0, 1000)))
def test_polynomials_are_the_removals_and_shapley_values(counts):
    p = filter_audit.RemovalPolynomial(counts, 4)
    removed = lambda s: sum(n for m, n in counts.items() if m & s)
    assert [p.corner(s) for s in range(16)] == [removed(s) for s in range(16)]
    orders = list(permutations(range(4)))
    for i in range(4):
        before = [sum(1 << j for j in o[: o.index(i)]) for o in orders]
        assert p.shapley(i) * 24 == sum(removed(b | 1 << i) - removed(b) for b in before)


# --- tokens -----------------------------------------------------------------------------------------

FILE = public_tokenizers.path("byte_bpe_50k.json")
VOCABULARY = token_counts.read_vocabulary(FILE)
LIBRARY = Tokenizer.from_file(FILE)
COUNTER = token_counts.Counter(VOCABULARY, token_counts.Params(remembered=500, long_text=300))
ODD = ["", " ", "x" * 20_000, "ab" * 5000, "a<|endoftext|>b <|endoftext|> c<|endoftext|>", "<|endoftext", "it's I'LL we'd 'S  123½ⅷ --- \r\n\n x", " \t\x1c\x85\xa0　᠎", "漢字🙂 été ß́", "՘࢏ letters of later Unicode \U00018cff", "\x00\x01\U0010ffff"]


def library_count(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_counts_are_the_librarys():
    assert [COUNTER.count(t) for t in ODD] == library_count(ODD)
    assert len(COUNTER.counts) <= 500


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(), st.sampled_from([" the", "ing", "'s", "<|endoftext|>", "\n\n  ", "12345", "aaaa", " été"]))).map("".join))
def test_counts_of_any_text_are_the_librarys(text):
    assert [COUNTER.count(text)] == library_count([text])


def test_op13_on_the_given_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    want = [(r.doc_id, len((r.text or "").encode()), n, n > 512) for r, n in zip(docs, library_count([r.text or "" for r in docs]))]
    got = op13_token_counts(spark, DATA).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_token_counts_of_odd_rows(spark):
    rows = [(i if i % 4 else None, t, "en", "s", 1) for i, t in enumerate([None, *ODD, *ODD])]
    got = token_counts.token_counts(doc_rows(spark, rows), VOCABULARY).collect()
    want = [(r[0], n) for r, n in zip(rows, library_count([r[1] or "" for r in rows]))]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in got), key=key) == sorted(want, key=key)
    assert token_counts.token_counts(doc_rows(spark, rows).limit(0), VOCABULARY).count() == 0


def test_other_kinds_of_vocabulary_are_refused():
    with pytest.raises(ValueError):
        token_counts.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
