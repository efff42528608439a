"""SimHash near-duplicates through a vantage-point tree of Hamming distances.

Fingerprints are 64-bit sums of votes over word shingles. Distinct fingerprints
are dealt to the leaves of a tree whose inner nodes hold a vantage fingerprint
and a radius: what lies within the radius goes left, the rest right. A
fingerprint has one home leaf; as a query with distance ``d`` it also visits
every leaf that the triangle inequality cannot rule out (both sides, where its
distance to the vantage is within ``d`` of the radius). Every linked pair meets
in the home leaf of either one, so leaves are searched on their own, by the
same kind of tree over what they hold, down to blocks compared pair by pair.

The upper tree is built from a bounded sample (``SAMPLE`` fingerprints, the
first by hash). It only balances the leaves: links do not depend on it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import cut, id_and_text
from .components import connected

#: Fingerprints the upper tree is built from (at most; a bound on what reaches the driver).
SAMPLE = 8192
#: Fingerprints of a leaf to aim at; the tree has as many levels as that takes.
LEAF = 16384
#: Inside a leaf, parts of at most this size are compared pair by pair.
BLOCK = 384


def fingerprint(words: list[bytes], shingle: int, digest) -> int:
    """The fingerprint of a text from its words: a bit is 1 if it is set in over
    half of the shingles' hashes. No words give 0, too few words one shingle."""
    n = len(words)
    if n == 0:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        return int.from_bytes(digest(joined, 42), "big")
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    ends = starts[shingle:]
    hashes = [digest(joined[a : b - 1], 42) for a, b in zip(starts, ends)]
    hashes.append(digest(joined[starts[n - shingle] :], 42))
    bits = np.unpackbits(np.frombuffer(b"".join(hashes), np.uint8).reshape(-1, 8), axis=1)
    return int.from_bytes(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; ``fp`` holds the 64 bits as a signed long,
    ``text_hash`` is xxhash64 of the text.

    A to Z are lower-cased; words are runs of bytes other than space and the
    control characters tab to carriage return; shingles, repeats included, are
    ``shingle`` words joined by one space and hashed by XXH64 with seed 42. A
    null text is an empty one: fingerprint zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_digest

        for batch in batches:
            fps = [fingerprint(t.as_py().encode().lower().split(), shingle, xxh64_digest) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "text_hash", "fp"])

    return id_and_text(docs).withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, "doc_id long, text_hash long, fp long")


def distances(points: np.ndarray, vantage) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


class Tree:
    """The upper tree: ``home(points)`` and ``visits(points, d)`` give leaf numbers."""

    def __init__(self, sample: np.ndarray, levels: int):
        self.levels = levels
        self.nodes: dict[int, tuple[np.uint64, int]] = {}  # number of the node -> vantage, radius
        self._split(1, np.sort(sample), levels)

    def _split(self, node: int, points: np.ndarray, left: int) -> None:
        if left == 0 or len(points) < 2:
            return
        vantage = points[len(points) // 2]
        d = distances(points, vantage)
        radius = int(np.median(d))
        self.nodes[node] = (vantage, radius)
        self._split(2 * node, points[d <= radius], left - 1)
        self._split(2 * node + 1, points[d > radius], left - 1)

    def home(self, points: np.ndarray) -> np.ndarray:
        leaf = np.zeros(len(points), np.int64)
        self._walk(1, np.arange(len(points)), points, 0, lambda node, rows: leaf.__setitem__(rows, node), True)
        return leaf

    def visits(self, points: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) pairs: every leaf a linked fingerprint of the row may have as home."""
        rows, leaves = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        self._walk(1, np.arange(len(points)), points, d, lambda node, r: (rows.append(r), leaves.append(np.full(len(r), node))), False)
        return np.concatenate(rows), np.concatenate(leaves)

    def _walk(self, node: int, rows: np.ndarray, points: np.ndarray, d: int, arrive, home: bool) -> None:
        if not len(rows):
            return
        if node not in self.nodes:
            arrive(node, rows)
            return
        vantage, radius = self.nodes[node]
        to = distances(points[rows], vantage).astype(np.int64)
        self._walk(2 * node, rows[to - d <= radius], points, d, arrive, home)
        self._walk(2 * node + 1, rows[to + d > radius], points, d, arrive, home)


class Forest:
    """Union-find over row numbers, joined by arrays of pairs."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = int(root[i])
        return i

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        new = self.root[a] != self.root[b]
        for i, j in zip(a[new].tolist(), b[new].tolist()):
            x, y = self.find(i), self.find(j)
            if x != y:
                self.root[max(x, y)] = min(x, y)
                self.links.append((i, j))


def search(points: np.ndarray, homes: np.ndarray, visitors: np.ndarray, d: int, forest: Forest) -> None:
    """Join every visitor with the homes within ``d`` of it (both are row numbers)."""
    todo = [(homes, visitors)]
    while todo:
        homes, visitors = todo.pop()
        if not len(homes) or not len(visitors):
            continue
        if len(homes) > BLOCK:
            vantage = points[homes[len(homes) // 2]]
            to = distances(points[homes], vantage).astype(np.int64)
            radius = int(np.median(to))
            near = to <= radius
            if near.all():  # more than half lie at the largest distance: cut below it
                radius -= 1
                near = to <= radius
            if near.any():
                v = distances(points[visitors], vantage).astype(np.int64)
                todo += [(homes[near], visitors[v - d <= radius]), (homes[~near], visitors[v + d > radius])]
                continue
        for h in range(0, len(homes), BLOCK):
            block = homes[h : h + BLOCK]
            for v in range(0, len(visitors), 2048):
                some = visitors[v : v + 2048]
                i, j = np.nonzero(distances(points[some][:, None], points[block][None, :]) <= d)
                forest.join(some[i], block[j])


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(u, v) links between distinct fingerprints (column ``fp``) that differ in at
    most ``max_bits`` bits: of each leaf, a spanning forest of its links. Their
    connected components are those of all links."""
    n = distinct.count()
    levels = max(0, (max(n, 1) // LEAF).bit_length())
    sample = [r.fp for r in distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()]
    tree = Tree(np.array(sample, np.int64).view(np.uint64), levels)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            points = fps.view(np.uint64)
            home = tree.home(points)
            rows, leaves = tree.visits(points, max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(leaves), pa.array(fps[rows]), pa.array(leaves == home[rows])], ["leaf", "fp", "home"])

    def leaf_links(pdf: pd.DataFrame) -> pd.DataFrame:
        points = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        forest = Forest(len(points))
        search(points, np.flatnonzero(pdf["home"].to_numpy(bool)), np.arange(len(points)), max_bits, forest)
        pairs = np.array(forest.links, np.int64).reshape(-1, 2)
        fps = points.view(np.int64)
        return pd.DataFrame({"u": fps[pairs[:, 0]], "v": fps[pairs[:, 1]]})

    return (distinct.select("fp").mapInArrow(deal, "leaf long, fp long, home boolean")
            .groupBy("leaf").applyInPandas(leaf_links, "u long, v long"))


def roots_of(docs: DataFrame, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """The rows' fingerprints, and (fp, root) of each: the smallest of its component."""
    rows = cut(fingerprints(docs, shingle), "simhash")
    distinct = cut(rows.select("fp").distinct(), "simhash-distinct")
    linked = connected(links(distinct, max_bits))
    return rows, distinct.join(linked, distinct.fp == linked.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """(doc_id, text_hash, fp, component_id) of every row of ``docs``.

    Rows are linked if their fingerprints differ in at most ``max_bits`` bits;
    ``component_id`` is the smallest doc_id reachable over links. Texts without
    words have fingerprint zero and are linked like any other. A null doc_id
    belongs to the component of its text but is never its smallest (a component
    of null ids alone has a null id); a repeated row is returned again; an empty
    table gives an empty table; other columns are not read.
    """
    rows, roots = roots_of(docs, shingle, max_bits)
    # First by fingerprint, then by component: a hot group is a few rows before it is shuffled.
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least")).join(roots, "fp")
    named = least.join(least.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    return rows.join(named.select("fp", "component_id"), "fp").select("doc_id", "text_hash", "fp", "component_id")


def keep_one_of_each(docs: DataFrame, shingle: int, max_bits: int) -> DataFrame:
    """One row of ``docs`` of each component, all its columns: the one of the smallest
    doc_id (null ids last; of rows that share it, the one with the smallest text hash)."""
    rows, roots = roots_of(docs, shingle, max_bits)
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    first = rows.groupBy("fp").agg(F.min(F.struct(number.alias("_number"), "text_hash")).alias("first")).join(roots, "fp")
    stay = first.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first._number").alias("_number"), F.col("first.text_hash").alias("_hash"))
    keyed = docs.withColumns({"_number": number, "_hash": F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})
    return keyed.join(stay, ["_number", "_hash"], "left_semi").dropDuplicates(["_number", "_hash"]).select(*docs.columns)
