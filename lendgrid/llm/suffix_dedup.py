"""Removal of byte strings that occur earlier, by families of suffix arrays.

A byte goes if it is covered by a string of ``length`` bytes that also starts
earlier (in a smaller document, or earlier in the same one). So a suffix
matters by its first ``length`` bytes alone, and its place in a suffix array is
given by their 128-bit fingerprint: any order that depends on these bytes only
puts equal ones side by side, which is all that the scan needs.

1. Anchors. Of the 32-byte strings inside a suffix's first ``length`` bytes, the
   one with the smallest hash is its anchor, so equal suffixes have equal
   anchors, and a run of neighbouring suffixes has one in common. Anchors of all
   documents are counted by hash, a few bytes each; suffixes whose anchor occurs
   once cannot have a match and are not looked at again.
2. Shards. The other suffixes go to shards by anchor, as stretches of text. An
   anchor that very many suffixes share (a passage that many documents hold)
   would be one large group; its suffixes are dealt one by one instead, by
   their own fingerprints. Stretches that are equal within one block of
   documents are sent once.
3. Index family. Within a shard, suffixes are added in document order, in
   batches. Each batch is sorted into a suffix array; it is scanned for matches
   in itself and against every existing level, and what is new becomes a level;
   levels of equal size merge, so that there are logarithmically many.
4. Spans. Matched suffixes return to their documents as runs; the bytes they
   cover are taken out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import ship_package

ANCHOR = 32
#: Bytes hashed together in a worker; longer texts are cut, with overlaps.
PIECE = 1 << 19
#: Rows of an Arrow batch taken up at a time, and anchors held before they are sent.
SLICE, HELD_ANCHORS = 500, 500_000
#: An anchor with more occurrences than this has its suffixes dealt one by one.
HOT = 2000
#: Suffixes of a batch of the index family.
BATCH = 1 << 17
#: Bytes of text in a group of documents that one task takes up, on average.
GROUP_BYTES = 64 << 20
#: What a shard is sent.
STRETCHES, FINGERPRINTS, MATCHED = 0, 1, 2
NO_ID = np.iinfo(np.int64).max  # sorts rows without an id last


@lru_cache(maxsize=8)
def _random(seed: int) -> tuple[np.ndarray, list[np.uint64]]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 64, 256, np.uint64), [np.uint64(x) for x in rng.integers(0, 1 << 63, 64, np.uint64) * 2 + 1]


def rolling(data: np.ndarray, length: int, seed: int) -> np.ndarray:
    """64-bit hash of the ``length`` bytes that start at each place, by doubling."""
    letters, factors = _random(seed)
    out, done, size, h = None, 0, 1, letters[data]
    parts = []
    while size <= length:
        if length & size:
            parts.append((size, h))
        if 2 * size <= length:
            h = h[:-size] * factors[size.bit_length()] + h[size:]
        size *= 2
    n = len(data) - length + 1
    for size, h in reversed(parts):
        out = h[:n].copy() if out is None else out * factors[32 + size.bit_length()] + h[done : done + n]
        done += size
    out ^= out >> np.uint64(32)
    out *= np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(29))


def least_of(h: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        h, size = np.minimum(h[:-size], h[size:]), 2 * size
    rest = width - size
    return np.minimum(h[:-rest], h[rest:]) if rest else h


def runs_of(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(document, first start, suffixes, anchor hash) of every run of neighbouring
    suffixes that share their anchor; ``document`` numbers the texts."""
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for number, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), PIECE):
            piece = text[at : at + PIECE + length - 1] if len(text) > PIECE else text
            if len(piece) < length:
                continue
            if size + len(piece) > PIECE + length:
                yield _runs(held, length)
                held, size = [], 0
            held.append((number, at, piece))
            size += len(piece)
    if held:
        yield _runs(held, length)


def _runs(held: list[tuple[int, int, bytes]], length: int):
    data = np.frombuffer(b"".join(p for _, _, p in held), np.uint8)
    sizes = np.array([len(p) for _, _, p in held])
    ends = np.cumsum(sizes)
    piece = np.repeat(np.arange(len(held)), sizes)
    anchors = rolling(data, ANCHOR, 1)
    # The smallest hash, and of equal ones the leftmost: the low bits hold the place.
    place_bits = np.uint64((1 << 23) - 1)
    coded = (anchors & ~place_bits) | np.arange(len(anchors), dtype=np.uint64)
    least = least_of(coded, length - ANCHOR + 1)
    starts = np.flatnonzero(piece[: len(least)] == piece[length - 1 : length - 1 + len(least)])
    chosen = (least[starts] & place_bits).astype(np.int64)
    first = np.flatnonzero(np.r_[True, np.diff(chosen) != 0])
    count = np.diff(np.r_[first, len(starts)])
    start = starts[first]
    own = piece[start]
    offset = np.array([at for _, at, _ in held]) - (ends - sizes)
    return np.array([n for n, _, _ in held])[own], start + offset[own], count, anchors[chosen[first]]


def blob(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, one behind the other; read back by :func:`unblob`."""
    return b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def unblob(data, *dtypes: str) -> list[np.ndarray]:
    width = sum(np.dtype(d).itemsize for d in dtypes)
    n, at, out = len(data) // width, 0, []
    for d in dtypes:
        out.append(np.frombuffer(data, d, n, at))
        at += n * np.dtype(d).itemsize
    return out


def grouped(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(value, places) of each value of ``key``."""
    order = np.argsort(key, kind="stable")
    edges = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0]) if len(key) else np.zeros(0, np.int64)
    for a, b in zip(edges, np.r_[edges[1:], len(key)]):
        yield int(key[order[a]]), order[a:b]


class Levels:
    """The index family of a shard: sorted arrays of the suffixes met so far."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Add a batch of suffixes, in document order, by the two halves of their
        fingerprints; which of them occurred earlier, in the batch or in a level."""
        order = np.argsort(one, kind="stable")
        a, b = one[order], two[order]
        earlier = np.zeros(len(a), bool)
        same = a[1:] == a[:-1]
        if (same & (b[1:] != b[:-1])).any():  # one half agrees by chance: put the other in order as well
            order = np.lexsort((two, one))
            a, b = one[order], two[order]
            same = a[1:] == a[:-1]
        earlier[1:] = same & (b[1:] == b[:-1])
        for one_of_level, two_of_level in self.levels:
            at = np.minimum(np.searchsorted(one_of_level, a), len(one_of_level) - 1)
            hit = one_of_level[at] == a
            earlier |= hit & (two_of_level[at] == b)
            for i in np.flatnonzero(hit & (two_of_level[at] != b)):
                k = int(at[i])
                while k < len(one_of_level) and one_of_level[k] == a[i]:
                    earlier[i] |= two_of_level[k] == b[i]
                    k += 1
        if not earlier.all():
            self.levels.append((a[~earlier], b[~earlier]))
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
            (a1, b1), (a2, b2) = self.levels.pop(), self.levels.pop()
            a, b = np.concatenate([a2, a1]), np.concatenate([b2, b1])
            merged = np.argsort(a, kind="stable")
            self.levels.append((a[merged], b[merged]))
        out = np.zeros(len(one), bool)
        out[order] = earlier
        return out


def fingerprints_of(stretches: bytes, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, place in it, both halves of the fingerprint) of every suffix of the
    stretches, which lie behind one another."""
    data = np.frombuffer(stretches, np.uint8)
    ends = np.cumsum(sizes)
    n = sizes - length + 1
    stretch = np.repeat(np.arange(len(sizes)), n)
    place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    at = place + np.repeat(ends - sizes, n)
    return stretch, place, rolling(data, length, 2)[at], rolling(data, length, 3)[at]


def compress(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(data)


def decompress(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def _batches(frame: pa.RecordBatch | pa.Table, name: str) -> list:
    return [x.as_py() for x in frame.column(name)]


def remove_repeats(docs: DataFrame, length: int = 100, as_text: bool = False) -> DataFrame:
    """The columns of ``docs`` but for ``text``, and of every row's text as UTF-8
    bytes: ``n_bytes``, ``spans`` (the maximal runs of removed bytes, array of start
    and end) and ``kept`` (the other bytes, concatenated) or, with ``as_text``,
    ``text``: the same as a string, without the characters of which a part is gone
    (a null text stays null).

    Documents are in order of doc_id, rows without one last; rows that share a
    doc_id are in order of a hash of their texts, and of exact repeats of a row one
    counts as the first. A null text is empty. Texts shorter than ``length`` lose
    nothing; longer ones than PIECE are hashed in pieces that overlap, so nothing is missed at
    their bounds. An empty table gives an empty table. Columns that are called like
    the added ones are replaced.
    """
    if length < ANCHOR:
        raise ValueError(f"length has to be {ANCHOR} at least")
    spark = docs.sparkSession
    ship_package(spark)
    # Blocks, buckets and shards: as many as there are shuffle partitions, and more where the texts would fill them beyond GROUP_BYTES.
    n_bytes = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // GROUP_BYTES))
    last = "text" if as_text else "kept"
    columns = [c for c in docs.columns if c not in ("text", "n_bytes", "spans", last)]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*columns).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))).alias("_id"),
                       F.xxhash64(text).alias("_hash"), F.col("text").isNull().alias("_null"), text.cast("binary").alias("_text"))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("_id", "_hash"), F.lit(parts)).cast("int"))

    def zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("_text")
            yield batch.set_column(at, "_text", pa.array([compress(t.as_py()) for t in batch.column(at)], pa.binary()))

    # --- 1: anchors, by hash, from all blocks
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(keys: list[np.ndarray], blocks: list[np.ndarray]) -> pa.RecordBatch:
            key, block = np.concatenate(keys), np.concatenate(blocks)
            order = np.lexsort((block, key))
            key, block = key[order], block[order]
            # A block's occurrences of an anchor, as one entry with their number.
            first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (block[1:] != block[:-1])])
            n = np.minimum(np.diff(np.r_[first, len(key)]), 65535).astype("<u2")
            key, block = key[first], block[first]
            found = [(b, blob(key[at], block[at], n[at])) for b, at in grouped((key % np.uint64(parts)).astype(np.int64))]
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.int32()), pa.array([d for _, d in found], pa.binary())], ["bucket", "data"])

        keys, blocks, held = [], [], 0
        for batch in batches:
            block = batch.column(0).to_numpy(zero_copy_only=False).astype("<u4")
            for at in range(0, len(batch), SLICE):
                for document, _, _, key in runs_of([t.as_py() for t in batch.column(1).slice(at, SLICE)], length):
                    keys.append(key), blocks.append(block[at + document])
                    held += len(key)
                if held > HELD_ANCHORS:
                    yield sent(keys, blocks)
                    keys, blocks, held = [], [], 0
        if held:
            yield sent(keys, blocks)

    def repeated(table: pa.Table) -> pa.Table:
        got = [unblob(d, "<u8", "<u4", "<u2") for d in _batches(table, "data")]
        key, block, n = (np.concatenate([g[i] for g in got]) for i in range(3))
        order = np.argsort(key, kind="stable")
        key, block, n = key[order], block[order], n[order].astype(np.int64)
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        total = np.repeat(np.add.reduceat(n, first), np.diff(np.r_[first, len(key)]))
        again = total > 1
        key, block, hot = key[again], block[again], total[again] > HOT
        found = [(b, blob(key[at], hot[at])) for b, at in grouped(block.astype(np.int64))]
        return pa.table({"_block": pa.array([b for b, _ in found], pa.int32()), "data": pa.array([d for _, d in found], pa.binary())})

    again = (rows.select("_block", "_text").mapInArrow(anchors, "bucket int, data binary")
             .groupBy("bucket").applyInArrow(repeated, "_block int, data binary"))

    # --- 2: stretches of text to shards
    def in_order(table: pa.Table) -> tuple[pa.Table, list[bytes]]:
        """A block's rows in document order (exact repeats side by side), and their texts."""
        table = table.sort_by([("_id", "ascending"), ("_hash", "ascending")])
        return table, [decompress(t) for t in _batches(table, "_text")]

    def stretches(docs_of_block: pa.Table, known: pa.Table) -> pa.Table:
        got = [unblob(d, "<u8", "?") for d in _batches(known, "data")]
        out: list[tuple[int, int, bytes, bytes, bytes]] = []  # shard, kind, documents, entries, text
        hot_ones: list[tuple[np.ndarray, ...]] = []  # document, start, both halves of the fingerprint
        table, texts = in_order(docs_of_block)
        block = table.column("_block")[0].as_py() if len(table) else -1
        ids = table.column("_id").to_numpy().astype("<i8")
        hashes = table.column("_hash").to_numpy().astype("<i8")

        def of_documents(document: np.ndarray, start: np.ndarray) -> bytes:
            return compress(blob(ids[document], hashes[document], document.astype("<u4"), start.astype("<i8")))

        if got and texts:
            keys, hots = (np.concatenate([g[i] for g in got]) for i in range(2))
            order = np.argsort(keys)
            keys, hots = keys[order], hots[order]
            for document, start, count, key in runs_of(texts, length):
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                use = keys[at] == key
                document, start, count, key, hot = document[use], start[use], count[use], key[use], hots[at[use]]
                pieces = [texts[d][s : s + c + length - 1] for d, s, c in zip(document.tolist(), start.tolist(), count.tolist())]
                for shard, r in grouped((key % np.uint64(parts)).astype(np.int64)):
                    r = r[~hot[r]]
                    if len(r):
                        out.append((shard, STRETCHES, of_documents(document[r], start[r]), blob(count[r].astype("<u4")), compress(b"".join(pieces[x] for x in r))))
                r = np.flatnonzero(hot)
                if len(r):
                    stretch, place, one, two = fingerprints_of(b"".join(pieces[x] for x in r), count[r] + length - 1, length)
                    hot_ones.append((document[r[stretch]], start[r[stretch]] + place, one, two))
        if hot_ones:
            document, start, one, two = (np.concatenate(c) for c in zip(*hot_ones))
            order = np.lexsort((start, document, two, one))
            again = np.r_[False, (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])]
            first, rest = order[~again], order[again]
            for shard, w in grouped((one[first] % np.uint64(parts)).astype(np.int64)):
                w = first[w]
                out.append((shard, FINGERPRINTS, of_documents(document[w], start[w]), blob(one[w], two[w]), b""))
            if len(rest):  # they have an earlier equal in the block: on their way back already
                rest = rest[np.lexsort((start[rest], document[rest]))]
                out.append((block, MATCHED, of_documents(document[rest], start[rest]), b"", b""))
        return pa.table({"shard": pa.array([o[0] for o in out], pa.int32()), "block": pa.array([block] * len(out), pa.int32()), "kind": pa.array([o[1] for o in out], pa.int32()),
                         "documents": pa.array([o[2] for o in out], pa.binary()), "entries": pa.array([o[3] for o in out], pa.binary()), "text": pa.array([o[4] for o in out], pa.binary())})

    zipped_rows = rows.select("_id", "_hash", "_block", "_text").mapInArrow(zipped, "_id long, _hash long, _block int, _text binary")
    sent = (zipped_rows.groupBy("_block").cogroup(again.groupBy("_block"))
            .applyInArrow(stretches, "shard int, block int, kind int, documents binary, entries binary, text binary"))

    # --- 3: the index family of each shard
    def matches(table: pa.Table) -> pa.Table:
        # Entries are stretches or, with their fingerprint, single suffixes (of which the text place is -1).
        per: list[list[np.ndarray]] = [[] for _ in range(9)]  # id, hash, document, block, start, suffixes, text place, one, two
        known: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.uint32), np.zeros(0, np.int32), np.zeros(0, np.int64))]
        texts, size = [], 0
        for block, kind, documents, entries, data in zip(*(_batches(table, c) for c in ("block", "kind", "documents", "entries", "text"))):
            ids, hashes, document, start = unblob(decompress(documents), "<i8", "<i8", "<u4", "<i8")
            n = len(ids)
            if kind == MATCHED:
                known.append((document, np.full(n, block, np.int32), start))
                continue
            if kind == FINGERPRINTS:
                one, two = unblob(entries, "<u8", "<u8")
                count, place = np.ones(n, np.int64), np.full(n, -1, np.int64)
            else:
                one = two = np.zeros(n, np.uint64)
                count = unblob(entries, "<u4")[0].astype(np.int64)
                texts.append(decompress(data))
                place = size + np.cumsum(count + length - 1) - (count + length - 1)
                size += len(texts[-1])
            for column, values in zip(per, (ids, hashes, document, np.full(n, block, np.int32), start, count, place, one, two)):
                column.append(values)
        if per[0]:
            text = np.frombuffer(b"".join(texts), np.uint8)
            del texts
            ids, hashes, document, block, start, count, place, one, two = (np.concatenate(c) for c in per)
            order = np.lexsort((start, document, hashes, ids))
            levels = Levels()
            upto = np.cumsum(count[order])
            at = 0
            while at < len(order):
                end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BATCH, "right")))
                entry = order[at:end]
                at = end
                n = count[entry]
                own = np.repeat(entry, n)
                within = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
                a, b = one[own], two[own]
                cut_out = entry[place[entry] >= 0]
                if len(cut_out):
                    stretch = np.concatenate([text[p : p + c + length - 1] for p, c in zip(place[cut_out].tolist(), count[cut_out].tolist())])
                    sizes = count[cut_out] + length - 1
                    first = np.repeat(np.cumsum(sizes) - sizes - (np.cumsum(count[cut_out]) - count[cut_out]), count[cut_out]) + np.arange(int(count[cut_out].sum()))
                    of_text = place[own] >= 0
                    a[of_text], b[of_text] = rolling(stretch, length, 2)[first], rolling(stretch, length, 3)[first]
                matched = levels.add(a, b)
                own, within = own[matched], within[matched]
                known.append((document[own], block[own], start[own] + within))
        document, block, start = (np.concatenate(c) for c in zip(*known))
        # Neighbouring starts of a document are one run.
        first = np.flatnonzero(np.r_[True, (np.diff(document.astype(np.int64)) != 0) | (np.diff(block) != 0) | (np.diff(start) != 1)]) if len(start) else np.zeros(0, np.int64)
        count = np.diff(np.r_[first, len(start)])
        document, block, start = document[first], block[first], start[first]
        found = [(b, blob(document[w], start[w], count[w].astype("<i8"))) for b, w in grouped(block.astype(np.int64))]
        return pa.table({"_block": pa.array([b for b, _ in found], pa.int32()), "data": pa.array([d for _, d in found], pa.binary())})

    runs = sent.groupBy("shard").applyInArrow(matches, "_block int, data binary")

    # --- 4: back to the documents
    spans_type = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([*docs.select(*columns).schema.fields, T.StructField("n_bytes", T.LongType()), T.StructField("spans", spans_type),
                           T.StructField(last, T.StringType() if as_text else T.BinaryType())])
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def kept(docs_of_block: pa.Table, found: pa.Table) -> pa.Table:
        table, texts = in_order(docs_of_block)
        got = [unblob(d, "<u4", "<i8", "<i8") for d in _batches(found, "data")]
        document, start, count = (np.concatenate([g[i] for g in got]) if got else np.zeros(0, np.int64) for i in range(3))
        of = dict(grouped(document.astype(np.int64)))
        spans, left = [], []
        for number, data in enumerate(texts):
            at = of.get(number)
            if at is None:
                spans.append([]), left.append([data])
                continue
            at = at[np.argsort(start[at])]
            s, e = start[at], np.maximum.accumulate(start[at] + count[at] + length - 1)
            first = np.flatnonzero(np.r_[True, s[1:] > e[:-1]])
            s, e = s[first], e[np.r_[first[1:] - 1, len(e) - 1]]
            spans.append([{"start": a, "end": b} for a, b in zip(s.tolist(), e.tolist())])
            left.append([data[a:b] for a, b in zip([0, *e.tolist()], [*s.tolist(), len(data)])])
        if as_text:
            # Each stretch by itself: what is left of two cut characters must not become a third one.
            nulls = _batches(table, "_null")
            final = pa.array([None if null else "".join(d.decode("utf-8", "ignore") for d in stretches) for stretches, null in zip(left, nulls)], pa.string())
        else:
            final = pa.array([b"".join(stretches) for stretches in left], pa.binary())
        row = table.column("row").combine_chunks()
        return pa.Table.from_arrays([*(row.field(i) for i in range(row.type.num_fields)), pa.array([len(t) for t in texts], pa.int64()), pa.array(spans, span_type), final],
                                    [f.name for f in schema.fields])

    return (rows.mapInArrow(zipped, rows.schema).groupBy("_block").cogroup(runs.groupBy("_block")).applyInArrow(kept, schema))
