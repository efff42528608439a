"""Token ids of a corpus as one concatenated array in binary shards.

A store is a Parquet dataset with one row per shard, in ascending document
order by (part, seq). The column ``image`` holds the shard in its own format:

    8 bytes   magic ``LGTOKEF1``
    header    documents, documents with a null id, bytes per token id, smallest id
    ids       Elias-Fano code of the document ids, less the smallest
    bounds    Elias-Fano code of the end offset of every document in the array
    tokens    the concatenated token ids, 2 or 4 bytes each, little-endian

Parquet is only the container: it gives Spark's commit protocol (a lost or
repeated task leaves no half shard) and any store that Spark can reach. Offsets
of documents come from select on the bounds; there is no 64-bit offset table.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from . import elias_fano
from .common import id_and_text
from .tokenizers import load

MAGIC = b"LGTOKEF1"
HEADER = struct.Struct("<QQBq")
SCHEMA = "part int, seq int, n_docs long, n_ids long, image binary"
#: A shard is closed when it holds this many token ids; a longer document has a shard to itself.
SHARD_IDS = 1 << 21


def shard_image(doc_ids: list[int | None], tokens: list[bytes], width: int) -> bytes:
    """The bytes of one shard; ``doc_ids`` ascending with nulls first, ``tokens``
    the little-endian unsigned 32-bit ids of each document."""
    known = np.array([i for i in doc_ids if i is not None], dtype=np.int64)
    least = int(known[0]) if len(known) else 0
    ends = np.cumsum([len(t) // 4 for t in tokens], dtype=np.int64) if tokens else np.zeros(0, np.int64)
    ids = np.frombuffer(b"".join(tokens), "<u4")
    return b"".join([MAGIC, HEADER.pack(len(doc_ids), len(doc_ids) - len(known), width, least),
                     elias_fano.encode(known.astype(np.uint64) - np.uint64(least & (2**64 - 1))), elias_fano.encode(ends),
                     ids.astype(f"<u{width}").tobytes()])


class Shard:
    """Reads one shard image."""

    def __init__(self, image: bytes):
        if image[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token shard")
        self.n_docs, self.n_null, width, self.least = HEADER.unpack_from(image, len(MAGIC))
        at = len(MAGIC) + HEADER.size
        self.ids = elias_fano.EliasFano(image, at)
        self.ends = elias_fano.EliasFano(image, at + self.ids.size)
        self.tokens = np.frombuffer(image, f"<u{width}", offset=at + self.ids.size + self.ends.size)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.n_null + (self.ids.all() + self.least).tolist()

    def start(self, i: int) -> int:
        return self.ends[i - 1] if i else 0

    def document(self, i: int) -> np.ndarray:
        """Token ids of the i-th document of the shard, by two selects."""
        return self.tokens[self.start(i) : self.ends[i]]

    def bounds(self) -> np.ndarray:
        """Start offsets of all documents, and the end of the last."""
        return np.concatenate([[0], self.ends.all()]).astype(np.int64)


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int, shard_ids: int = SHARD_IDS) -> None:
    """Encode every whole text, append ``end_id`` to each, and write the store.

    Documents are dealt by ranges of doc_id and sorted, so the store is in
    ascending doc_id order (null ids first; rows that share a doc_id in the
    order of their texts). A null text is empty and holds the end id alone, an
    empty table writes no shard, repeated rows are stored again, and columns
    other than doc_id and text are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(tokenizer)
        width = 2 if max(coder.n_vocab, end_id + 1) <= 1 << 16 else 4
        end = end_id.to_bytes(4, "little")
        part, seq = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        tokens: list[bytes] = []
        held = 0

        def shard() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)], pa.int64()),
                                               pa.array([held], pa.int64()), pa.array([shard_image(ids, tokens, width)], pa.binary())],
                                              ["part", "seq", "n_docs", "n_ids", "image"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = coder.ids(text.as_py()) + end
                if ids and held + len(own) // 4 > shard_ids:
                    yield shard()
                    ids, tokens, held, seq = [], [], 0, seq + 1
                ids.append(doc_id)
                tokens.append(own)
                held += len(own) // 4
        if ids:
            yield shard()

    rows = id_and_text(docs)
    (rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
     .mapInArrow(run, SCHEMA).write.parquet(path))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, shard_part, shard_seq) of every stored
    document; ``start`` counts the token ids of all documents before it."""
    shards = spark.read.schema(SCHEMA).parquet(path)
    # Shards before this one: whole parts first, then the earlier shards of the part.
    sizes = shards.select("part", "seq", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n_part"))
    before = parts.withColumn("part_start", F.coalesce(F.sum("n_part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = (sizes.join(before.select("part", "part_start"), "part")
              .select("part", "seq", (F.col("part_start") + within).alias("shard_start")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, image in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                shard = Shard(image.as_py())
                bounds, tokens = shard.bounds(), shard.tokens.astype("<u4")
                crcs = [zlib.crc32(tokens[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                n = shard.n_docs
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids(), pa.int64()), pa.array(bounds[:-1]), pa.array(np.diff(bounds)), pa.array(crcs, pa.int64()),
                     pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int32())],
                    ["doc_id", "local_start", "n_tokens", "ids_crc32", "part", "seq"])

    rows = shards.select("part", "seq", "image").mapInArrow(run, "doc_id long, local_start long, n_tokens long, ids_crc32 long, part int, seq int")
    return (rows.join(starts, ["part", "seq"])
            .select("doc_id", (F.col("shard_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32",
                    F.col("part").alias("shard_part"), F.col("seq").alias("shard_seq")))


def documents_tokens(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, tokens array<int>) of the named documents, each found by a binary
    search over the shard's ids and two selects."""
    wanted = sorted(set(doc_ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for image in batch.column(0):
                shard = Shard(image.as_py())
                ids = shard.ids.all() + shard.least
                hits = [(d, j) for d in wanted for j in range(int(np.searchsorted(ids, d)), int(np.searchsorted(ids, d, "right")))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d for d, _ in hits], pa.int64()), pa.array([shard.document(shard.n_null + j).astype(np.int32) for _, j in hits], pa.list_(pa.int32()))],
                    ["doc_id", "tokens"])

    return spark.read.schema(SCHEMA).parquet(path).select("image").mapInArrow(run, "doc_id long, tokens array<int>")
