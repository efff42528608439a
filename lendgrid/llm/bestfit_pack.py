"""Packing of documents into sequences: dominance reduction, then best fit.

Documents longer than a sequence are cut into full pieces; only the first
piece is shorter. Pieces have whole lengths from 1 to ``capacity``, so the
packing problem is fully described by how many pieces have each length: at most
``capacity`` numbers, whatever the corpus holds. The plan is made on these
numbers, and pieces then look up their place in it by their rank among the
pieces of the same length.

The plan first applies the dominance criterion of Martello and Toth: a set of
pieces that fits one sequence may be fixed for good if every other set around
its largest piece could be swapped for it without needing more sequences.
From the longest piece down, for one of length x, with y the longest that fits
beside it:

* nothing fits: x is fixed alone;
* x + y fills the sequence, or no two pieces fit beside x: {x, y} is fixed;
* at most two pieces fit beside x: with a >= b the pair of the largest sum
  that fits, {x, y} is fixed if y >= a + b; {x, a, b} is fixed if y = a and no
  pair that fits has both pieces longer than b.

Fixing a set shrinks the instance, and is repeated while its pieces last. A
length for which no rule holds stays in the instance; what is left in the end
is packed best fit by decreasing length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import cut, id_and_text
from .tokenizers import load

#: Parts that the pieces of one length are ranked in, at least, and pieces of a part if all had one length.
LEAST_SALTS, PART_PIECES = 64, 1 << 20


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens."""
    first = n % capacity
    cuts = ([(0, first)] if first else []) + [(s, capacity) for s in range(first, n, capacity)]
    return cuts


class Counts:
    """How many pieces of each length are left; lengths ascending."""

    def __init__(self, counts: dict[int, int]):
        self.n = {length: n for length, n in counts.items() if n > 0}
        self.lengths = sorted(self.n)

    def take(self, length: int, n: int) -> None:
        self.n[length] -= n
        if not self.n[length]:
            del self.n[length]
            self.lengths.pop(bisect_left(self.lengths, length))

    def give(self, length: int, n: int) -> None:
        if length not in self.n:
            self.n[length] = 0
            self.lengths.insert(bisect_left(self.lengths, length), length)
        self.n[length] += n

    def longest_up_to(self, room: int) -> int | None:
        at = bisect_left(self.lengths, room + 1)
        return self.lengths[at - 1] if at else None

    def least_sum(self, k: int, above: int = 0) -> int | None:
        """Sum of the k shortest pieces longer than ``above``, None if there are fewer."""
        total = 0
        for length in self.lengths[bisect_left(self.lengths, above + 1) :]:
            some = min(k, self.n[length])
            total, k = total + some * length, k - some
            if not k:
                return total
        return None

    def best_pair(self, room: int) -> tuple[int, int] | None:
        """The pair a >= b with the largest sum up to ``room``; of equal sums the one with the largest a."""
        best = None
        for a in reversed(self.lengths):
            if a >= room or (best and 2 * a < sum(best)):
                continue
            b = self.longest_up_to(min(room - a, a))
            if b == a and self.n[a] < 2:
                b = self.longest_up_to(a - 1)
            if b is not None and (best is None or a + b > sum(best)):
                best = (a, b)
        return best


def dominating_set(left: Counts, x: int, capacity: int) -> tuple[int, ...] | None:
    """The set around one piece of length ``x`` that dominates all others, if a rule
    finds one; ``left`` holds the other pieces."""
    room = capacity - x
    y = left.longest_up_to(room)
    if y is None:
        return (x,)
    two, three = left.least_sum(2), left.least_sum(3)
    if y == room or two is None or two > room:
        return (x, y)
    if three is not None and three <= room:
        return None
    a, b = left.best_pair(room)
    if y >= a + b:
        return (x, y)
    beyond = left.least_sum(2, above=b)  # of pairs whose shorter piece is longer than b
    if y == a and (beyond is None or beyond > room):
        return (x, a, b)
    return None


def reduce_dominated(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """(fixed, rest): sets of lengths with how many sequences hold each, and the counts left.

    Fixing a set takes pieces away, so a rule that held goes on holding while the
    pieces of its set last; all these copies are fixed at once.
    """
    left, fixed = Counts(counts), []
    for x in sorted(left.n, reverse=True):
        while left.n.get(x):
            left.take(x, 1)
            found = dominating_set(left, x, capacity)
            left.give(x, 1)
            if found is None:
                break
            n = min(left.n[length] // found.count(length) for length in found)
            for length in found:
                left.take(length, n)
            fixed.append((found, n))
    return fixed, dict(left.n)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit by decreasing length over counts: sequences that are alike are kept
    as one pattern and how many there are of it."""
    open_by_room: dict[int, list[list]] = defaultdict(list)  # room -> [pattern, how many]
    rooms: list[int] = []

    def put(pattern: tuple[int, ...], room: int, n: int) -> None:
        if n:
            if not open_by_room[room]:
                rooms.insert(bisect_left(rooms, room), room)
            open_by_room[room].append([pattern, n])

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect_left(rooms, length)
            if at == len(rooms):  # none fits: open new ones, each filled with as many copies as it takes
                per = capacity // length
                full, more = divmod(n, per)
                put((length,) * per, capacity - per * length, full)
                put((length,) * more, capacity - more * length, 1 if more else 0)
                break
            room = rooms[at]
            pattern, have = open_by_room[room].pop()
            if not open_by_room[room]:
                rooms.pop(at)
            per = room // length
            full = min(have, n // per)
            put(pattern + (length,) * per, room - per * length, full)
            n, have = n - full * per, have - full
            if have and n and n < per:
                put(pattern + (length,) * n, room - n * length, 1)
                n, have = 0, have - 1
            put(pattern, room, have)
    return [(pattern, n) for room in rooms for pattern, n in open_by_room[room]]


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], int]:
    """All patterns with how many sequences hold each, and the number fixed by dominance."""
    fixed, rest = reduce_dominated(counts, capacity)
    return fixed + best_fit(rest, capacity), sum(n for _, n in fixed)


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """length -> (first rank, sequence of that rank, offset): ranks from one first
    rank up to the next lie at that offset of consecutive sequences."""
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    sequence = 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            runs[length].append((used[length], sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    return {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in runs.items()}


def tokenized_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, spread) of every piece of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = load(tokenizer), end_id.to_bytes(4, "little")
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = memoryview(coder.ids(text.as_py()) + end)
                for k, (start, length) in enumerate(pieces_of(len(ids) // 4, capacity)):
                    for column, value in zip(out, (doc_id, k, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64()), pa.array(out[4], pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = id_and_text(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")
    return rows.withColumn("spread", F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()))


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    A document is its whole text's token ids and ``end_id``; a null text is empty
    and gives one piece with the end id alone. A repeated row is packed again, a
    null doc_id stays null, a text of any length is encoded whole, an empty table gives an
    empty table, and columns other than doc_id and text are not read. Only the numbers of pieces by
    length, at most ``capacity`` rows, reach the driver.
    """
    pieces = cut(tokenized_pieces(docs, tokenizer, end_id, capacity), "pieces")
    # Most pieces of long documents have one length, the full one: the number of parts follows that of all pieces.
    salts = max(LEAST_SALTS, -(-pieces.count() // PART_PIECES))
    pieces = pieces.withColumn("salt", F.pmod("spread", F.lit(salts)).cast("int"))
    by_salt = cut(pieces.groupBy("length", "salt").agg(F.count("*").alias("n")), "piece-counts")
    counts = {r.length: r.n for r in by_salt.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = slots(plan(counts, capacity)[0])

    # The rank of a piece among those of its length: those in earlier salts, then within its salt.
    earlier = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = by_salt.select("length", "salt", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "salt").orderBy("spread")
    ranked = (pieces.withColumn("own", F.row_number().over(own) - 1).join(before, ["length", "salt"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("own")).alias("rank")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (3, 5))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order], prepend=-1))
            for a, b in zip(edges, [*edges[1:], len(order)]):
                rows = order[a:b]
                first, base, at = places[int(length[rows[0]])]
                run = np.searchsorted(first, rank[rows], "right") - 1
                sequence[rows], offset[rows] = base[run] + rank[rows] - first[run], at[run]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), pa.array(sequence), pa.array(offset)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
