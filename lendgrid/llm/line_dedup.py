"""Line deduplication: a line that several documents hold stays in one of them.

Every line that counts becomes one row (hash of its key, document, place). The
rows are range-partitioned and sorted by hash, document (largest first) and
place, so a line's rows lie side by side and the first document of a run is the
one that keeps it. A task streams its sorted rows and needs to remember nothing
but the run it is in. A range can end inside a run (a line that a third of all
documents hold fills many ranges), so a task leaves the rows of its first and last
run open; what they lack, the number of documents and the largest one, comes from
an aggregate over the open rows, of which there are at most two hashes a task.

The result is a compressed bitmap of kept lines for each document, not text:
texts are read once for the hashes, and again only by who asks for kept texts.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import cut, ship_package

# Fixed value: the white space that is no part of a key.
BLANK = b"\x20\t\n\x0b\x0c\r"
#: Lines to a row of the bitmap while it is put together.
WORD_BITS = 64


def key_of(line: bytes) -> bytes:
    return line.strip(BLANK).lower()  # of bytes: A-Z alone


def long_enough(key: bytes, least: int) -> bool:
    """Whether the key has ``least`` code points (bytes that do not continue one)."""
    return len(key) >= least and (key.isascii() or sum(b & 0xC0 != 0x80 for b in key) >= least)


def encode_keep(keep: np.ndarray) -> bytes:
    """A bitmap of kept lines, the first line in the lowest bit, compressed."""
    return zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 6)


def decode_keep(data: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(data), np.uint8), count=n_lines, bitorder="little").astype(bool)


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, text): rows that share a doc_id are told apart by their text."""
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))


def line_rows(docs: DataFrame, least_chars: int) -> DataFrame:
    """(doc_id, text_hash, h1, h2, place): a row for each line whose key is long enough, and
    one without hash for each document, whose place is its number of lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, open_, hashes = [], [], [], []
            for row, text in enumerate(batch.column(2)):
                lines = text.as_py().split(b"\n")
                rows.append(row), places.append(len(lines)), open_.append(True), hashes.append(bytes(16))
                for place, line in enumerate(lines):
                    if len(line) >= least_chars and long_enough(key := key_of(line), least_chars):
                        rows.append(row), places.append(place), open_.append(False)
                        hashes.append(hashlib.blake2b(key, digest_size=16).digest())
            pair = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            none = np.array(open_, bool)
            at = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(pair[:, 0], mask=none), pa.array(pair[:, 1], mask=none), pa.array(places, pa.int64())],
                                             ["doc_id", "text_hash", "h1", "h2", "place"])

    return _texts(docs).mapInArrow(run, "doc_id long, text_hash long, h1 long, h2 long, place long")


COLUMNS = ["doc_id", "text_hash", "h1", "h2", "place", "open"]
NO_ID = np.iinfo(np.int64).min


class Run:
    """The run of equal hashes that a task has reached but not ended.

    Its rows pass straight through once ``least_docs`` documents are known, so what is
    held does not grow with the run: the rows of the second document up to the last but one needed."""

    def __init__(self, key: tuple, edge: bool):
        self.key, self.edge = key, edge
        self.seen: list[int] = []  # its first documents, at most as many as are needed
        self.last, self.docs = None, 0
        self.held: list[pa.RecordBatch] = []


def marked(batch: pa.RecordBatch, open_: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(batch), open_))], COLUMNS)


def judge_runs(ordered: DataFrame, least_docs: int) -> DataFrame:
    """Of rows sorted within each task by hash and document (falling) those that are
    dropped, and the open ones: all of a task's first run, and of its last one the rows that
    wait for more documents and one row without place for each of its first documents."""

    def extend(run: Run, batch: pa.RecordBatch, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        if run.edge:  # what lies before a task's first run is not known here
            yield marked(batch, True)
            return
        new = np.concatenate([[ids[0] != run.last], ids[1:] != ids[:-1]])
        run.seen.extend(ids[new][: least_docs - len(run.seen)].tolist())
        run.docs, run.last = run.docs + int(new.sum()), ids[-1]
        behind = np.flatnonzero(ids != run.seen[0])
        if len(behind):
            run.held.append(batch.take(pa.array(behind)))
        if run.docs >= least_docs:
            yield from (marked(held, False) for held in run.held)
            run.held = []

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: Run | None = None
        for batch in batches:
            if not len(batch):
                continue
            h1, h2 = batch.column("h1").to_numpy(), batch.column("h2").to_numpy()
            ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()  # a null id is one document, below all others
            goes_on = run is not None and run.key == (h1[0], h2[0])
            changed = np.concatenate([[not goes_on], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
            starts = np.flatnonzero(changed)
            begin = 0
            if goes_on or run is None:  # rows of the run at hand, or of the task's first one
                begin = int(starts[0 if goes_on else 1]) if len(starts) > (0 if goes_on else 1) else len(batch)
                run = run or Run((h1[0], h2[0]), edge=True)
                yield from extend(run, batch.slice(0, begin), ids[:begin])
            if begin == len(batch):
                continue
            last = int(starts[-1])
            if last > begin:  # runs that begin and end here
                first = starts[(starts >= begin) & (starts < last)] - begin
                own = ids[begin:last]
                new = np.concatenate([[True], own[1:] != own[:-1]]) | changed[begin:last]
                size = np.diff(np.append(first, last - begin))
                enough = np.repeat(np.add.reduceat(new, first, dtype=np.int64) >= least_docs, size)
                lost = np.flatnonzero(enough & (own != np.repeat(own[first], size)))
                if len(lost):
                    yield marked(batch.slice(begin, last - begin).take(pa.array(lost)), False)
            run = Run((h1[last], h2[last]), edge=False)
            yield from extend(run, batch.slice(last), ids[last:])
        if run is not None and not run.edge:
            yield from (marked(held, True) for held in run.held)
            n = len(run.seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([None if i == NO_ID else i for i in run.seen], pa.int64()), pa.nulls(n, pa.int64()), pa.array([run.key[0]] * n, pa.int64()),
                 pa.array([run.key[1]] * n, pa.int64()), pa.nulls(n, pa.int64()), pa.array([True] * n, pa.bool_())], COLUMNS)

    return ordered.mapInArrow(judge, "doc_id long, text_hash long, h1 long, h2 long, place long, open boolean")


def keep_bitmaps(docs: DataFrame, least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """(doc_id, text_hash, n_lines, n_dropped, keep): of each document the number of lines and
    the compressed bitmap of those that stay (``decode_keep``; null where all stay).

    A text is split at line feeds; a null or empty one is one empty line. A line's key is
    the line without ``BLANK`` at its ends, A-Z lower-cased. A key of at least ``least_chars``
    code points that at least ``least_docs`` documents hold loses all its lines but those in the
    largest doc_id that holds it (there, all of them stay: the tie has no other order). Rows that
    share a doc_id are one document in this count, told apart by xxhash64 of the text in the
    result; exact repeats of a row share one result row. A null doc_id is one document, smaller than
    all others. Texts of any length are taken whole: a line is held by itself, a text by its task. An
    empty table gives an empty table; other columns are not read.
    """
    lines = cut(line_rows(docs, least_chars), "lines")
    hashed = lines.filter("h1 is not null")
    ordered = (hashed.repartitionByRange("h1", "h2", F.desc_nulls_last("doc_id"), "place", "text_hash")
               .sortWithinPartitions("h1", "h2", F.desc_nulls_last("doc_id"), "place", "text_hash"))
    judged = cut(judge_runs(ordered, least_docs), "line-runs")
    open_ = judged.filter("open")
    # At most two hashes a task of the range partitioning have open rows, which bounds this side.
    verdicts = (open_.select("h1", "h2", "doc_id").distinct().groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("largest"))
                .filter(F.col("docs") >= least_docs).select("h1", "h2", "largest"))
    late = (open_.filter("place is not null").join(F.broadcast(verdicts), ["h1", "h2"])
            .filter(F.col("doc_id").isNull() | (F.col("doc_id") < F.col("largest"))))
    lost = judged.filter("not open").select("doc_id", "text_hash", "place").union(late.select("doc_id", "text_hash", "place"))
    # Bits of one word are put together before they travel; the words of a document then meet its number of lines.
    word, bit = F.expr(f"place div {WORD_BITS}").alias("word"), F.expr(f"shiftleft(1L, cast(place % {WORD_BITS} as int))")
    words = lost.groupBy("doc_id", "text_hash", word).agg(F.bit_or(bit).alias("bits"))
    of_doc = words.select("doc_id", "text_hash", F.struct("word", "bits").alias("w"), F.lit(None).cast("long").alias("n_lines"))
    whole = lines.filter("h1 is null").select("doc_id", "text_hash", F.lit(None).cast("struct<word:long,bits:long>").alias("w"), F.col("place").alias("n_lines"))
    grouped = of_doc.union(whole).groupBy("doc_id", "text_hash").agg(F.max("n_lines").alias("n_lines"), F.collect_list("w").alias("words"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dropped, keeps = [], []
            for n_lines, words in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                bits = np.zeros(-(-n_lines // WORD_BITS), np.int64)
                for w in words:
                    bits[w["word"]] = w["bits"]
                lost = np.unpackbits(bits.view(np.uint8), count=n_lines, bitorder="little")
                dropped.append(int(lost.sum()))
                keeps.append(encode_keep(1 - lost) if words else None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(dropped, pa.int64()), pa.array(keeps, pa.binary())], ["doc_id", "text_hash", "n_lines", "n_dropped", "keep"])

    return grouped.mapInArrow(pack, "doc_id long, text_hash long, n_lines long, n_dropped long, keep binary")


def kept_texts(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) of every row of ``docs``: ``kept`` is the text (UTF-8 bytes)
    of the lines that ``bitmaps`` keeps, joined by line feeds."""
    of = bitmaps.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t"), "n_lines", "n_dropped", "keep")
    texts = _texts(docs)
    joined = texts.join(of, texts["doc_id"].eqNullSafe(of["d"]) & (texts["text_hash"] == of["t"])).select("doc_id", "n_lines", "n_dropped", "keep", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for keep, text in zip(batch.column(3), batch.column(4)):
                if keep.is_valid:
                    lines = text.as_py().split(b"\n")
                    kept.append(b"\n".join([lines[i] for i in np.flatnonzero(decode_keep(keep.as_py(), len(lines)))]))
                else:
                    kept.append(text.as_py())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(kept, pa.binary())], ["doc_id", "n_lines", "n_dropped", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept binary")
