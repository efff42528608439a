"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over neighbouring words: the hash of the words at its
marked places, whatever stands at the others. Two passages that differ in some
words still share a seed wherever the substituted words fall on unmarked
places. Seeds of the benchmark items and of the documents are joined; every
hit gives a diagonal (place in the document less place in the item), and the
item is laid over the document along it and compared word by word.

A document's seeds are first held against a Bloom filter of the benchmark's
seeds. It has a fixed number of bits, whatever the benchmark holds; it only
keeps seeds from the join that cannot meet any.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import cut, ship_package

#: The masks, 1 for a place that counts, by the items they are for. Whichever words differ in an overlap
#: that counts, one mask fits between them: cut the item into blocks of three (two) words; at most a fifth of the
#: words differ, each spoils one block, and so many whole blocks are left that two of them lie within the mask's span.
THREES = tuple("111" + "000" * gap + "111" for gap in range(5))
TWOS = ("1111", "110011")
#: All but one word of five.
FIVE = ("1111", "10111", "11011", "11101")
#: Items of fewer words are no evidence and are not looked for.
LEAST_ITEM = 5
#: An overlap counts if this share of its words is equal, and it has the whole item or this many equal words.
SIMILAR, EQUAL_WORDS = 0.8, 12
BLOOM_BITS = 1 << 23
#: Copies of each benchmark seed, over which a much repeated seed's hits are dealt.
SALTS = 16
#: Words hashed together in a worker.
BATCH_WORDS = 1 << 18
#: Words of at most so many characters whose hashes a worker keeps, and how many; the table is emptied when it is full.
KEPT_CHARS, MOST_WORDS = 48, 250_000

WORD = re.compile(r"\w+")
_FACTORS = np.random.default_rng(20240607).integers(1 << 32, 1 << 63, size=64, dtype=np.uint64) | np.uint64(1)


class WordHashes(dict):
    """word -> 64-bit hash."""

    def __missing__(self, word: str) -> int:
        from xxhash import xxh3_64_intdigest

        h = xxh3_64_intdigest(word.encode("utf-8", "replace"))
        if len(word) <= KEPT_CHARS:
            if len(self) >= MOST_WORDS:
                self.clear()
            self[word] = h
        return h


_hashes = WordHashes()


def word_hashes(text: str) -> np.ndarray:
    words = WORD.findall(text.lower())
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def seeds(words: np.ndarray, mask: str, number: int) -> np.ndarray:
    """The seed at every place where ``mask`` fits."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    key = np.full(n, number + 1, np.uint64)
    for place, (bit, factor) in enumerate(zip(mask, _FACTORS)):
        if bit == "1":
            key += words[place : place + n] * factor
    return mix(key)


def masks_for(length: int) -> tuple[str, ...]:
    """The masks for an item of ``length`` words."""
    if length < LEAST_ITEM:
        return ()
    if length == LEAST_ITEM:
        return FIVE
    return TWOS if length in (6, 7, 8, 10, 11) else THREES


def bits_of(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (key % np.uint64(BLOOM_BITS)).astype(np.int64), ((key >> np.uint64(32)) % np.uint64(BLOOM_BITS)).astype(np.int64)


def overlap(document: np.ndarray, item: np.ndarray, diagonal: int) -> tuple[int, int, int] | None:
    """(equal words, first, end place in the document) of the item laid over the
    document at ``diagonal``, if the overlap counts."""
    a, b = max(0, -diagonal), min(len(item), len(document) - diagonal)
    equal = document[a + diagonal : b + diagonal] == item[a:b]
    if equal.sum() >= SIMILAR * len(item):
        at = np.flatnonzero(equal)
        return int(equal.sum()), int(a + diagonal + at[0]), int(a + diagonal + at[-1] + 1)
    # The stretch with the largest surplus of equal words over the share that has to be equal.
    gain = np.concatenate([[0.0], np.cumsum(np.where(equal, 1 - SIMILAR, -SIMILAR))])
    least = np.minimum.accumulate(gain)
    end = int(np.argmax(gain - least))
    first = int(np.flatnonzero(gain[: end + 1] == least[end])[0])
    n = int(equal[first:end].sum())
    if n >= min(EQUAL_WORDS, len(item)):
        return n, a + diagonal + first, a + diagonal + end
    return None


def find_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, equal_words, item_words, first_word, end_word):
    for every document and item the largest overlap, if there is one that counts.

    ``text_hash`` (xxhash64 of the text) tells rows apart that share a doc_id;
    exact repeats of a row give one result. Words are runs of word characters,
    lower-cased. Null and empty texts have no words and overlap with nothing;
    null ids are kept as they are; items that share an id are looked for each;
    empty tables give an empty table; other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)

    def hashed_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [word_hashes(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([w.tobytes() for w in words], pa.binary()), pa.array([len(w) for w in words], pa.int32())],
                                             ["item_id", "item", "n"])

    items = cut(benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
                .mapInArrow(hashed_items, "item_id long, item binary, n int").filter(F.col("n") >= LEAST_ITEM)
                .distinct().withColumn("item_key", F.xxhash64("item_id", "item")), "items")
    # Which of the three sets of masks the items need.
    kind = F.when(F.col("n") == LEAST_ITEM, LEAST_ITEM).when(F.col("n").isin(6, 7, 8, 10, 11), 6).otherwise(9)
    masks = sorted({mask for r in items.select(kind.alias("n")).distinct().collect() for mask in masks_for(r.n)})

    def item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = np.frombuffer(data.as_py(), np.uint64)
                for number, mask in enumerate(masks):
                    if mask not in masks_for(len(words)):
                        continue
                    found = seeds(words, mask, number)
                    one, two = bits_of(found)
                    yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array([key] * len(found), pa.int64()), pa.array(np.arange(len(found), dtype=np.int32)),
                                                      pa.array(one), pa.array(two)], ["seed", "item_key", "item_place", "one", "two"])

    of_items = cut(items.select("item_key", "item").mapInArrow(item_seeds, "seed long, item_key long, item_place int, one long, two long"), "item-seeds")
    # The filter as 64-bit words: BLOOM_BITS / 64 rows at most.
    bits = of_items.select(F.explode(F.array("one", "two")).alias("bit"))
    filled = bits.groupBy(F.shiftright("bit", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("v")).collect()
    bloom = np.zeros(BLOOM_BITS // 64, np.uint64)
    bloom[[r.w for r in filled]] = np.array([r.v for r in filled], np.int64).view(np.uint64)
    bloom = np.unpackbits(bloom.view(np.uint8), bitorder="little").astype(bool)
    shared = spark.sparkContext.broadcast(np.packbits(bloom, bitorder="little").tobytes())

    def document_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(np.frombuffer(shared.value, np.uint8), bitorder="little").astype(bool)

        def found(ids: list, hashes: list, texts: list[np.ndarray]) -> pa.RecordBatch:
            words = np.concatenate(texts)
            ends = np.cumsum([len(t) for t in texts])
            document = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
            hits: list[tuple[np.ndarray, np.ndarray]] = []
            for number, mask in enumerate(masks):
                key = seeds(words, mask, number)
                one, two = bits_of(key)
                at = np.flatnonzero(known[one])
                at = at[known[two[at]]]
                at = at[document[at] == document[at + len(mask) - 1]] if len(at) else at
                hits.append((at, key[at]))
            at = np.concatenate([np.zeros(0, np.int64), *(h[0] for h in hits)])
            key = np.concatenate([np.zeros(0, np.uint64), *(h[1] for h in hits)])
            order = np.argsort(at, kind="stable")
            at, key = at[order], key[order]
            rows = np.unique(document[at])
            first = np.searchsorted(document[at], rows)
            offsets = np.append(first, len(at)).astype(np.int32)
            starts = ends - [len(t) for t in texts]
            return pa.RecordBatch.from_arrays(
                [pa.array([ids[r] for r in rows], pa.int64()), pa.array([hashes[r] for r in rows], pa.int64()), pa.array([texts[r].tobytes() for r in rows], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(key.view(np.int64))),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array((at - starts[document[at]]).astype(np.int32)))],
                ["doc_id", "text_hash", "words", "seeds", "places"])

        ids, hashes, texts, held = [], [], [], 0
        for batch in batches:
            for doc_id, text_hash, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                own = word_hashes(text.as_py())
                if len(own):
                    ids.append(doc_id), hashes.append(text_hash), texts.append(own)
                    held += len(own)
                if held > BATCH_WORDS:
                    yield found(ids, hashes, texts)
                    ids, hashes, texts, held = [], [], [], 0
        if texts:
            yield found(ids, hashes, texts)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    suspects = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
                   .mapInArrow(document_seeds, "doc_id long, text_hash long, words binary, seeds array<long>, places array<int>"), "suspects")
    hits = (suspects.select("doc_id", "text_hash", F.explode(F.arrays_zip("seeds", "places")).alias("h"))
            .select("doc_id", "text_hash", F.col("h.seeds").alias("seed"), F.col("h.places").alias("place"))
            .withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SALTS))))
    salted = of_items.select("seed", "item_key", "item_place", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("salt"))
    diagonals = hits.join(salted, ["seed", "salt"]).select("doc_id", "text_hash", "item_key", (F.col("place") - F.col("item_place")).alias("diagonal")).distinct()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, text_hashes, diagonal, words, item_ids, item = (batch.column(i) for i in range(6))
            out: list[list] = [[] for _ in range(7)]
            for i in range(len(batch)):
                own, at = np.frombuffer(item[i].as_py(), np.uint64), diagonal[i].as_py()
                begin = max(at, 0)  # of the words at hand in the document
                if found := overlap(np.frombuffer(words[i].as_py(), np.uint64), own, at - begin):
                    for column, value in zip(out, (doc_ids[i].as_py(), text_hashes[i].as_py(), item_ids[i].as_py(), found[0], len(own), found[1] + begin, found[2] + begin)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["doc_id", "text_hash", "item_id", "equal_words", "item_words", "first_word", "end_word"])

    once = suspects.select("doc_id", "text_hash", "words").dropDuplicates(["doc_id", "text_hash"])
    # Of a document only the words beside the item go to the check, 8 bytes each: a long one has many diagonals.
    beside = F.expr("substring(words, cast(greatest(diagonal, 0) * 8 + 1 as int), n * 8)").alias("words")
    laid = (diagonals.join(items.select("item_key", "item_id", "item", "n"), "item_key")
            .join(once.withColumnsRenamed({"doc_id": "d", "text_hash": "t"}), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t")))
            .select("doc_id", "text_hash", "diagonal", beside, "item_id", "item"))
    overlaps = laid.mapInArrow(verify, "doc_id long, text_hash long, item_id long, equal_words long, item_words long, first_word long, end_word long")
    best = F.max(F.struct("equal_words", (-F.col("first_word")).alias("minus_first"), "item_words", "end_word")).alias("b")
    return overlaps.groupBy("doc_id", "text_hash", "item_id").agg(best).select(
        "doc_id", "text_hash", "item_id", "b.equal_words", "b.item_words", (-F.col("b.minus_first")).alias("first_word"), "b.end_word")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, that overlap with no benchmark item."""
    bad = find_overlaps(docs, benchmark).select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct()
    own = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["bad_id"]) & (own == bad["bad_hash"]), "left_anti")
