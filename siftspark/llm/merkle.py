"""A Merkle manifest of a dataset: a root, a root for each group, and a proof for each row.

A group's rows are leaves in order. Each run of 16 nodes, the last one shorter, becomes one node, the hash of their
hex digests, until one node is left; the roots of the groups, in order, likewise become the root of all.

Rows are dealt to ranges of (group, order) and written. A range knows from the counts of the earlier ones (one
row for each range and group) where its rows stand in their group, so it can build all subtrees that lie within it, down to
the last complete node. What is left at its two borders, fewer than 16 nodes on each level, meets the neighbours'
by coordinate (group, level, number of the run) in a shuffle; so do their parents, level by level. The same
way makes the tree over the groups. Then each range gets back the runs that were finished elsewhere, two at most on
each level, beside its rows, and gives every row its siblings up to the root.

The ranges are cut so that none has many more than ``part_rows`` rows, however large a group is; a range holds the digests of
one group's rows in memory. The driver gets two rows for each range.

Defined results: a null group or order comes first. Rows that tie in the order follow by leaf; equal leaves have equal
subtrees wherever they stand, so repeated rows get their places in any order. An empty table has no rows; a lone
leaf is its group's root, and a lone group's root is the root, without siblings. Other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftspark.operators.ordering import ROW_BITS
from siftspark.session import checkpointed, find_package

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
DIGITS = 64


@dataclass(frozen=True)
class Params:
    """``part_rows``: rows of a range; ``slice_rows``: rows whose proofs are held at once."""

    fanout: int = 16
    part_rows: int = 250_000
    slice_rows: int = 1024


# --- hashes ---------------------------------------------------------------------------------------


def leaf(*values: Column) -> Column:
    """The hash of a row: of each value its bytes and ``:`` before it, or ``-`` for null."""
    written = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*written), 256)


def fold(start: Column, siblings: Column) -> Column:
    """The root that a leaf and its siblings give: it is the true one if the leaf is."""
    return F.aggregate(siblings, start, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def proof_digest(siblings: Column) -> Column:
    """The hash of all siblings, from below, left to right."""
    return F.sha2(F.array_join(F.transform(siblings, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


class Subtrees:
    """The complete nodes of a group of ``size`` rows over those from ``start`` on whose digests are given.

    ``levels``: for each level but the root's, the number of the first complete node, these nodes, the number of the first complete
    run, and of each complete run its nodes joined.
    """

    def __init__(self, digests: list[str], start: int, size: int, fanout: int) -> None:
        self.fanout, self.first, self.last = fanout, start, start + len(digests) - 1
        self.levels: list[tuple[int, list[str], int, list[str]]] = []
        nodes = digests
        while size > 1:
            end = start + len(nodes)
            up = -(-start // fanout)
            stop = -(-end // fanout) if end == size else end // fanout
            runs = ["".join(nodes[p * fanout - start : (p + 1) * fanout - start]) for p in range(up, stop)]
            self.levels.append((start, nodes, up, runs))
            nodes, start, size = [_hash(r) for r in runs], up, -(-size // fanout)
        self.root = nodes[0] if nodes else None

    def ragged(self) -> Iterator[tuple[int, int, str]]:
        """(level, number, digest) of the complete nodes whose run is not complete here."""
        for level, (start, nodes, up, runs) in enumerate(self.levels):
            end, left = start + len(nodes), max(start, min(start + len(nodes), up * self.fanout))
            for i in (*range(start, left), *range(max(left, (up + len(runs)) * self.fanout) if runs else left, end)):
                yield level, i, nodes[i - start]

    def missing(self) -> Iterator[tuple[int, int]]:
        """(level, number) of the nodes above these rows whose runs are not complete here."""
        for level, (_, _, up, runs) in enumerate(self.levels):
            width = self.fanout ** (level + 1)
            for p in sorted({self.first // width, self.last // width}):
                if not up <= p < up + len(runs):
                    yield level + 1, p

    def siblings(self, begin: int, end: int, finished: dict[tuple[int, int], str]) -> np.ndarray:
        """Digests before and after each of the rows begin to end (by number in the group) and its ancestors: one row, two columns for each level."""
        out = np.empty((end - begin, 2 * len(self.levels)), object)
        rows = np.arange(begin, end)
        for level, (_, _, up, runs) in enumerate(self.levels):
            low, high = begin // self.fanout**level, (end - 1) // self.fanout**level
            before, after = np.empty(high - low + 1, object), np.empty(high - low + 1, object)
            for i in range(low, high + 1):
                p, place = divmod(i, self.fanout)
                run = runs[p - up] if up <= p < up + len(runs) else finished[level + 1, p]
                before[i - low], after[i - low] = run[: DIGITS * place], run[DIGITS * (place + 1) :]
            at = rows // self.fanout**level - low
            out[:, 2 * level], out[:, 2 * level + 1] = before[at], after[at]
        return out


# --- steps ----------------------------------------------------------------------------------------


def _dealt(rows: DataFrame, order: Sequence[Column], params: Params) -> DataFrame:
    """(_part, _at, ...): the rows in ranges of the order, written."""
    spark = rows.sparkSession
    n = rows.count()
    parts = max(-(-n // params.part_rows), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // 1000)), 1)
    keyed = rows.withColumn("_tie", F.monotonically_increasing_id())  # rows are written, so it stays
    ranged = keyed.repartitionByRange(parts, *order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    written = checkpointed(ranged.withColumn("_at", F.monotonically_increasing_id()))
    return written.select(F.shiftright("_at", ROW_BITS).alias("_part"), F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_at"), *ranged.columns)


def _places(dealt: DataFrame) -> dict[int, tuple[int, int, int]]:
    """By range: rows of its first group in earlier ranges, and rows in all of its first and of its last group."""
    per = dealt.groupBy("_part", "_group").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("at"))
    group = F.struct("_group", "n")
    ends = per.groupBy("_part").agg(F.min_by(group, "at").alias("first"), F.max_by(group, "at").alias("last"), F.count(F.lit(1)).alias("groups")).collect()
    totals: list[int] = []
    runs, last = [], None  # of each range, the runs of ranges that its first and its last group belong to
    found = {}
    for r in sorted(ends, key=lambda r: r["_part"]):
        if last is None or last["_group"] != r["first"]["_group"]:
            totals.append(0)
        found[r["_part"]] = totals[-1]
        totals[-1] += r["first"]["n"]
        first = len(totals) - 1
        if r["groups"] > 1:
            totals.append(r["last"]["n"])
        runs.append((r["_part"], first, len(totals) - 1))
        last = r["last"]
    return {part: (found[part], totals[a], totals[z]) for part, a, z in runs}


_BUILT = "kind string, part bigint, _group {}, at bigint, start bigint, size bigint, level int, number bigint, digest string"


def _built(dealt: DataFrame, places: dict[int, tuple[int, int, int]], params: Params) -> DataFrame:
    """What each range makes: a row for each group with its root where the range has all of it, its ragged
    nodes, and which runs it cannot finish. Written."""
    schema = _BUILT.format(dealt.schema["_group"].dataType.simpleString())

    def of_group(part: int, group: object, at: int, digests: list[str], last: bool) -> Iterator[tuple]:
        first, of_first, of_last = places[part]
        start, size = (first, of_first) if at == 0 else (0, of_last if last else len(digests))
        tree = Subtrees(digests, start, size, params.fanout)
        whole = len(digests) == size
        yield "group", part, group, at, start, size, None, None, tree.root if whole else None
        if not whole:
            for level, i, digest in tree.ragged():
                yield "node", part, group, at, start, size, level, i, digest
            for level, i in tree.missing():
                yield "need", part, group, at, start, size, level, i, None

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, group, at, digests = 0, None, 0, []
        out: list[tuple] = []
        names = [c.split()[0] for c in schema.split(", ")]

        def flushed(least: int) -> Iterator[pa.RecordBatch]:
            if len(out) > least:
                yield pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                out.clear()

        for batch in batches:
            kinds = [pa.string(), pa.int64(), batch.schema.field("_group").type, pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
            part = batch.column("_part")[0].as_py()
            for k, (g, digest) in enumerate(zip(batch.column("_group").to_pylist(), batch.column("_leaf").to_pylist(), strict=True)):
                if digests and g != group:
                    out.extend(of_group(part, group, at, digests, False))
                    digests = []
                if not digests:
                    group, at = g, batch.column("_at")[k].as_py()
                digests.append(digest)
            yield from flushed(10_000)
        if digests:
            out.extend(of_group(part, group, at, digests, True))
        yield from flushed(0)

    return checkpointed(dealt.select("_part", "_at", "_group", "_leaf").mapInArrow(build, schema))


def _finished(built: DataFrame, most: int, params: Params) -> DataFrame:
    """(_group, size, level, number, run, digest): the nodes over ragged ones, with the digests of their runs. Written."""
    nodes = built.filter("kind = 'node'")
    levels, width, made = [], 1, None
    level = 0
    while width < most:
        here = nodes.filter(F.col("level") == level).select("_group", "size", "number", "digest")
        if made is not None:
            here = here.unionByName(made.filter(F.col("size") > width).select(*here.columns))
        children = F.array_sort(F.collect_list(F.struct("number", "digest")))
        runs = here.groupBy("_group", "size", F.expr(f"number div {params.fanout}").alias("_up")).agg(children.alias("_children"))
        run = F.array_join(F.transform("_children", lambda c: c["digest"]), "")
        level, width = level + 1, width * params.fanout
        made = runs.select("_group", "size", F.lit(level).alias("level"), F.col("_up").alias("number"), run.alias("run"), F.sha2(run, 256).alias("digest"))
        levels.append(made)
    if not levels:
        return nodes.limit(0).select("_group", "size", "level", "number", F.lit("").alias("run"), "digest")
    out = levels[0]
    for made in levels[1:]:
        out = out.unionByName(made)
    return checkpointed(out)


@dataclass(frozen=True)
class _Tree:
    dealt: DataFrame
    parts: int
    groups: DataFrame
    needs: DataFrame
    finished: DataFrame
    roots: DataFrame


def _tree(rows: DataFrame, order: Sequence[Column], params: Params) -> _Tree:
    """From written rows (_group, _leaf, ...): the ranges, their groups and open runs, the upper nodes, and (_group, size, subroot)."""
    dealt = _dealt(rows, order, params)
    places = _places(dealt)
    built = _built(dealt, places, params)
    spread = [size for _, a, z in places.values() for size in (a, z)]
    finished = _finished(built, max(spread, default=0), params)
    groups, needs = built.filter("kind = 'group'"), built.filter("kind = 'need'")
    tops = finished.filter(F.col("size") <= F.pow(F.lit(float(params.fanout)), "level"))
    whole = groups.filter("digest IS NOT NULL").select("_group", "size", F.col("digest").alias("subroot"))
    return _Tree(dealt, len(places), groups, needs, finished, whole.unionByName(tops.select("_group", "size", F.col("digest").alias("subroot"))))


_SIBLINGS = "array<struct<before: string, after: string>>"


def _proofs(tree: _Tree, above: DataFrame | None, params: Params) -> DataFrame:
    """(_row, position, size, subroot, root, siblings) for each row. ``above``: (_group, root, siblings) of the groups' roots."""
    up = tree.finished.select(F.col("_group").alias("_g"), F.col("level").alias("_l"), F.col("number").alias("_n"), "run")
    here = (F.col("_group").eqNullSafe(F.col("_g"))) & (F.col("level") == F.col("_l")) & (F.col("number") == F.col("_n"))
    runs = tree.needs.join(up, here).groupBy("part", "at").agg(F.collect_list(F.struct("level", "number", "run")).alias("runs"))
    roots = tree.roots.select(F.col("_group").alias("_g"), "subroot")
    if above is None:
        roots = roots.withColumns({"root": F.col("subroot"), "siblings": F.array().cast(_SIBLINGS)})
    else:
        roots = roots.join(above.select(F.col("_group").alias("_h"), "root", "siblings"), F.col("_g").eqNullSafe(F.col("_h"))).drop("_h")
    paths = tree.groups.select("part", "at", "start", "size", "_group").join(roots, F.col("_group").eqNullSafe(F.col("_g"))).join(runs, ["part", "at"], "left")
    empty = F.array().cast("array<struct<level: int, number: bigint, run: string>>")
    path = F.struct("start", "size", "subroot", "root", "siblings", F.coalesce("runs", empty).alias("runs")).alias("_path")
    kind = tree.dealt.select("_row").schema["_row"].dataType
    heads = paths.select(F.col("part").alias("_part"), F.col("at").alias("_at"), F.lit(0).alias("_kind"), path, F.lit(None).cast(kind).alias("_row"), F.lit(None).cast("string").alias("_leaf"))
    rows = tree.dealt.select("_part", "_at", F.lit(1).alias("_kind"), F.lit(None).cast(heads.schema["_path"].dataType).alias("_path"), "_row", "_leaf")
    beside = heads.unionByName(rows).repartition(max(1, tree.parts), "_part").sortWithinPartitions("_part", "_at", "_kind")

    def of_group(path: dict, rows: pa.Array, digests: list[str]) -> Iterator[pa.RecordBatch]:
        tree_ = Subtrees(digests, path["start"], path["size"], params.fanout)
        finished = {(r["level"], r["number"]): r["run"] for r in path["runs"]}
        above_ = np.array([x for s in path["siblings"] for x in (s["before"], s["after"])], object)
        for k in range(0, len(digests), params.slice_rows):
            n = min(params.slice_rows, len(digests) - k)
            begin = path["start"] + k
            flat = np.hstack([tree_.siblings(begin, begin + n, finished), np.tile(above_, (n, 1))]).reshape(-1, 2)
            pairs = pa.StructArray.from_arrays([pa.array(flat[:, c], pa.string()) for c in (0, 1)], ["before", "after"])
            ends = pa.array(np.arange(n + 1, dtype=np.int32) * (len(flat) // n))
            same = lambda v, kind=pa.string(): pa.repeat(pa.scalar(v, kind), n)  # noqa: B023, E731
            columns = [rows.slice(k, n), pa.array(np.arange(begin, begin + n)), same(path["size"], pa.int64()), same(path["subroot"]), same(path["root"]), pa.ListArray.from_arrays(ends, pairs)]
            yield pa.record_batch(columns, names=["_row", "position", "size", "subroot", "root", "siblings"])

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, rows_, digests = None, [], []
        for batch in batches:
            kinds = batch.column("_kind").to_numpy(zero_copy_only=False)
            cuts = [*np.flatnonzero(kinds == 0).tolist(), batch.num_rows]
            for begin, end in zip([-1, *cuts[:-1]], cuts, strict=True):
                if begin >= 0:  # a group begins
                    if digests:
                        yield from of_group(path, pa.concat_arrays(rows_), digests)
                    path, rows_, digests = batch.column("_path")[begin].as_py(), [], []
                if end > begin + 1:
                    own = batch.slice(begin + 1, end - begin - 1)
                    rows_.append(own.column("_row"))
                    digests += own.column("_leaf").to_pylist()
        if digests:
            yield from of_group(path, pa.concat_arrays(rows_), digests)

    return beside.mapInArrow(prove, f"_row {kind.simpleString()}, position bigint, size bigint, subroot string, root string, siblings {_SIBLINGS}")


def _of(rows: DataFrame, group: str, order: str, params: Params) -> tuple[_Tree, DataFrame]:
    """The tree of the rows, and (_group, root, siblings) of its groups."""
    find_package(rows.sparkSession)
    first = lambda c: F.col(c).asc_nulls_first()
    keyed = rows.select(F.struct("*").alias("_row"), F.col(group).alias("_group"), F.col(order).alias("_order"), F.col("leaf").alias("_leaf"))
    tree = _tree(checkpointed(keyed), [first("_group"), first("_order"), F.col("_leaf")], params)
    roots = tree.roots.select(F.struct("_group").alias("_row"), F.lit(0).alias("_group"), F.col("_group").alias("_order"), F.col("subroot").alias("_leaf"))
    over = _proofs(_tree(checkpointed(roots), [first("_order")], params), None, params)
    return tree, checkpointed(over.select("_row._group", "root", "siblings"))


# --- the operator ---------------------------------------------------------------------------------


def leaves(docs: DataFrame, columns: Sequence[str] = COLUMNS) -> DataFrame:
    """The rows with ``leaf``, the hash of the columns. Select what the proofs shall carry of them."""
    return docs.withColumn("leaf", leaf(*[F.col(c) for c in columns]))


def manifest(rows: DataFrame, group: str = "source", order: str = "doc_id", params: Params = Params()) -> DataFrame:
    """(group, size, subroot, root): what to keep of a dataset, one row for each group. ``rows`` have ``leaf``."""
    tree, above = _of(rows.select(group, order, "leaf"), group, order, params)
    found = tree.roots.join(above.select(F.col("_group").alias("_g"), "root"), F.col("_group").eqNullSafe(F.col("_g")))
    return found.select(F.col("_group").alias(group), "size", "subroot", "root")


def changed_groups(old: DataFrame, new: DataFrame, group: str = "source") -> DataFrame:
    """(group, change): the groups of two manifests that were added, removed or changed."""
    side = lambda m, name: m.select(F.col(group).alias(f"_{name}"), F.col("subroot").alias(name))
    both = side(old, "old").join(side(new, "new"), F.col("_old").eqNullSafe(F.col("_new")), "full")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "changed")
    return both.select(F.when(F.col("old").isNull(), F.col("_new")).otherwise(F.col("_old")).alias(group), change.alias("change")).filter("change IS NOT NULL")


def proofs(rows: DataFrame, group: str = "source", order: str = "doc_id", params: Params = Params()) -> DataFrame:
    """The rows, which have ``leaf``, as ``_row``, with their position and number of rows in their group, the group's ``subroot``, the
    ``root`` of all, and their ``siblings`` from below: on each level the digests before and after. :func:`fold` verifies."""
    tree, above = _of(rows, group, order, params)
    return _proofs(tree, above, params)


def tampered(text: str = "text", folds: int = 5) -> Column:
    """For every fifth row, by crc32 of its id, the leaf that it would have with A-Z of its text lower-cased; else null."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    values = [F.translate(F.col(c), upper, upper.lower()) if c == text else F.col(c) for c in COLUMNS]
    return F.when(F.crc32(F.col("doc_id").cast("string")) % folds == 0, leaf(*values))
