"""Source divergence audit: how far the words of a language's sources lie apart.

A task takes its texts in slices of Arrow rows, ordered by language and source.
Every word start of a slice becomes a pointer into the slice's bytes, and the
pointers of each language are sorted by a multikey quicksort. Equal words are then
one run of pointers; as the sort is stable, a run lists them by source and
document, so its boundaries give occurrences and documents of each source without
a look-up. Only these counts leave the task.

Terms are dealt by (lang, term), a row for each slice and source at most. The
divergence of two sources is a sum over all terms, of which most have only one of
the two or none. It is put together from what a source's own counts say (a
histogram of its counts against the value of a term that the other lacks) and from
the terms that both have, for which a task adds up matrices of its terms by sources.
All of it is integer arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import byte_words
from .common import cut, ship_package

#: Probabilities are integers on this scale.
SCALE = 1_000_000_000
#: A term's byte: itself, A-Z lower-cased; zero for the bytes between terms.
TERM_BYTES = np.array([b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 0x20 if 0x41 <= b <= 0x5A else 0 for b in range(256)], np.uint8)
#: Rows (of whole terms) that a task turns into a matrix of terms by sources at a time.
PIECE_ROWS = 4096
#: Rows that a task emits at a time.
BATCH_ROWS = 1 << 17


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


def count_slice(langs: pa.Array, sources: pa.Array, texts: pa.Array) -> Iterator[pa.RecordBatch]:
    """(lang, term, source, n, docs) of rows that are ordered by lang and source."""
    buffer, first = byte_words.joined(texts, TERM_BYTES, b"\0")
    starts, lengths = byte_words.spans(buffer != 0)
    text = (np.searchsorted(first, starts, side="right") - 1).astype(np.int32)
    langs, sources = langs.dictionary_encode(), sources.dictionary_encode()
    lang, source = langs.indices.to_numpy(), sources.indices.to_numpy()
    ends = np.flatnonzero(np.concatenate([lang[1:] != lang[:-1], [True]])) + 1
    for a, b in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist()):  # the rows of one language
        i, j = np.searchsorted(text, [a, b])
        if i == j:
            continue
        own_starts, own_lengths = starts[i:j], lengths[i:j]
        order, new = byte_words.sort_pointers(buffer, own_starts, own_lengths)
        of_text = text[i:j][order]
        of_source = source[of_text]
        new_source, new_text = new.copy(), new.copy()
        new_source[1:] |= of_source[1:] != of_source[:-1]
        new_text[1:] |= of_text[1:] != of_text[:-1]
        at = np.flatnonzero(new_source)
        n = np.diff(np.append(at, len(order)))
        docs = np.add.reduceat(new_text, at, dtype=np.int64)
        pointers = order[at]
        for k in range(0, len(at), BATCH_ROWS):
            some = slice(k, k + BATCH_ROWS)
            rows = len(at[some])
            yield pa.RecordBatch.from_arrays(
                [pa.DictionaryArray.from_arrays(pa.array(np.full(rows, lang[a], np.int32)), langs.dictionary).dictionary_decode(),
                 byte_words.strings(buffer, own_starts[pointers[some]], own_lengths[pointers[some]]),
                 pa.DictionaryArray.from_arrays(pa.array(of_source[at[some]]), sources.dictionary).dictionary_decode(), pa.array(n[some]), pa.array(docs[some])],
                ["lang", "term", "source", "n", "docs"])


def slice_counts(docs: DataFrame) -> DataFrame:
    """(lang, term, source, n, docs): the occurrences of every term and the documents that hold it, slice by slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in byte_words.row_slices(batch.column(2)):
                rows = batch.slice(a, b - a)
                order = pc.sort_indices(pa.table([rows.column(0), rows.column(1), pa.array(np.arange(b - a))], ["lang", "source", "row"]),
                                        [("lang", "ascending"), ("source", "ascending"), ("row", "ascending")])
                yield from count_slice(*(column.take(order) for column in rows.columns))

    ship_package(docs.sparkSession)
    return docs.select(_text("lang"), _text("source"), _text("text").cast("binary")).mapInArrow(run, "lang string, term string, source string, n long, docs long")


def kept_terms(docs: DataFrame, least_docs: int) -> DataFrame:
    """(lang, term, source, n, lang_n, lead): the counts of every term that ``least_docs`` documents
    of its language hold; ``lead`` marks one row of each term."""
    dealt = cut(slice_counts(docs), "audit-slices").repartition("lang", "term")
    # Both steps keep the dealing by (lang, term): one shuffle, of at most a row a slice and source for a term.
    counts = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    return (counts.select("lang", "term", "source", "n", F.sum("docs").over(of_term).alias("docs"), F.sum("n").over(of_term).alias("lang_n"),
                          (F.row_number().over(of_term.orderBy("source")) == 1).alias("lead"))
            .filter(F.col("docs") >= least_docs).drop("docs"))


def probability(count: str, total: str) -> str:
    """SQL for 1 + floor(SCALE * (count + 2) / total), exact in longs while 1000 * total fits
    one: long division, three decimal digits at a time."""
    rest, value = f"({count} + 2)", f"1 + ({count} + 2) div {total} * {SCALE}"
    for digits in (1_000_000, 1_000, 1):
        rest = f"({rest} % {total} * 1000)"
        value += f" + {rest} div {total} * {digits}"
    return value


def divergence(p: str, q: str) -> str:
    """SQL for floor((p - q) ** 2 / (p + q))."""
    return f"({p} - {q}) * ({p} - {q}) div ({p} + {q})"


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def shared_terms(terms: DataFrame) -> DataFrame:
    """(lang, one, other, value): for two sources (one < other) the sum over the terms that both hold
    of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0), where p0 and q0 are the values of a term that is not there.

    ``terms`` (lang, term, source, p, absent_p) is dealt by (lang, term), so a task has whole terms."""

    def sums(lang: str, rows: pa.Table, row: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Of whole terms of one language; ``row`` numbers them."""
        names = rows.column("source").combine_chunks().dictionary_encode()
        labels = names.dictionary.to_pylist()
        order = sorted(range(len(labels)), key=lambda i: labels[i].encode())
        rank = np.empty(len(labels), np.int64)
        rank[order] = np.arange(len(labels))
        labels, column = [labels[i] for i in order], rank[names.indices.to_numpy()]
        absent = np.zeros(len(labels), np.int64)
        absent[column] = rows.column("absent_p").to_numpy()
        cells = np.zeros((int(row[-1]) + 1, len(labels)), np.int64)
        cells[row, column] = rows.column("p").to_numpy()
        for one in range(len(labels) - 1):
            held = cells[cells[:, one] > 0]
            own, others, none, nones = held[:, one, None], held[:, one + 1 :], absent[one], absent[None, one + 1 :]
            both = others > 0
            found = _divergence(own, others) - _divergence(own, nones) - _divergence(none, others) + _divergence(none, nones)
            at = np.flatnonzero(both.any(axis=0))
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array([labels[one]] * len(at), pa.string()),
                                                  pa.array([labels[one + 1 + k] for k in at], pa.string()), pa.array((found * both).sum(axis=0)[at])], ["lang", "one", "other", "value"])

    def changes(column: pa.ChunkedArray) -> np.ndarray:
        """Whether each row differs from the one before (the first one does)."""
        values = column.combine_chunks()
        return np.concatenate([[True], pc.not_equal(values.slice(1), values.slice(0, len(values) - 1)).to_numpy(zero_copy_only=False)])

    def whole_terms(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        new_lang = changes(rows.column("lang"))
        new = new_lang | changes(rows.column("term"))
        first = np.flatnonzero(new)
        # Pieces of whole terms of one language, of some PIECE_ROWS rows.
        piece = np.cumsum(new_lang)[first] * (len(rows) + 1) + first // PIECE_ROWS
        bounds = np.append(first[np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))], len(rows)).tolist()
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield from sums(rows.column("lang")[a].as_py(), rows.slice(a, b - a), np.cumsum(new[a:b]) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not len(batch):
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            # The last term may go on in the next batch.
            last = int(np.flatnonzero(changes(rows.column("lang")) | changes(rows.column("term")))[-1])
            if last:
                yield from whole_terms(rows.slice(0, last))
            held = rows.slice(last)
        if held is not None:
            yield from whole_terms(held)

    ordered = terms.repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    return (ordered.select("lang", "term", "source", "p", "absent_p").mapInArrow(run, "lang string, one string, other string, value long")
            .groupBy("lang", "one", "other").agg(F.sum("value").alias("value")))


def audit(docs: DataFrame, least_docs: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank): for every source of every language all other sources
    of the language by divergence (part ``pair``), and the ``top`` terms that set it apart from the
    language as a whole (part ``term``).

    Terms are runs of ASCII letters and characters beyond ASCII, A-Z lower-cased. A language keeps the V
    terms that ``least_docs`` of its rows hold. With N occurrences of kept terms in a group,
    p = 1 + floor(10^9 (count + 2) / (N + 2 V)); two values p and q differ by floor((p - q)^2 / (p + q)).
    A pair's value is the sum over all kept terms, 0 where there are none; a term's is that
    against the language's q, for terms the group holds with p > q. Ties go to the item that is smaller in UTF-8.

    Null text, lang and source are empty ones, and an empty name is a name. Every row is a document, a
    repeated one again; doc_id is not read, nor is any other column. A text of any length is taken
    whole, as a slice of its own. Empty texts make their group known; an empty table gives an empty one.
    """
    terms = cut(kept_terms(docs, least_docs), "audit-terms")
    sources = terms.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = terms.filter("lead").groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    # A row for each language and source; the joins with it are Spark's choice by its size.
    groups = cut(docs.select(_text("lang"), _text("source")).distinct().join(sources, ["lang", "source"], "left").join(langs, "lang", "left")
                 .select("lang", "source", F.coalesce("v", F.lit(0)).alias("v"),
                         # 1 where a language keeps no term: nothing is then divided by it but the constant
                         F.expr("greatest(coalesce(total, 0) + 2 * coalesce(v, 0), 1)").alias("denominator"),
                         F.expr("greatest(coalesce(lang_total, 0) + 2 * coalesce(v, 0), 1)").alias("lang_denominator"))
                 .withColumn("absent_p", F.expr(probability("0L", "denominator"))), "audit-groups")
    valued = terms.join(groups, ["lang", "source"]).withColumn("p", F.expr(probability("n", "denominator")))

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    apart = (valued.withColumn("q", F.expr(probability("lang_n", "lang_denominator"))).filter("p > q")
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(divergence("p", "q")).alias("value"))
             .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top))

    others = groups.select("lang", F.col("source").alias("item"), F.col("absent_p").alias("absent_q"))
    # A source's counts, each with the number of terms that have it, against the value of a term the other lacks.
    own = valued.groupBy("lang", "source", "n").agg(F.count("*").alias("terms"), F.first("p").alias("p"), F.first("absent_p").alias("absent_p"))
    alone = (own.join(others, "lang").filter("source != item").groupBy("lang", "source", "item")
             .agg(F.expr(f"sum(terms * ({divergence('p', 'absent_q')} - {divergence('absent_p', 'absent_q')}))").alias("value")))
    shared = shared_terms(valued)
    parts = (groups.select("lang", "source", "v", "absent_p").join(others, "lang").filter("source != item")
             .select("lang", "source", "item", F.expr(f"v * ({divergence('absent_p', 'absent_q')})").alias("value"))
             .union(alone.select("lang", "source", "item", "value"))
             .union(alone.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
             .union(shared.select("lang", "one", "other", "value"))
             .union(shared.select("lang", "other", "one", "value")))
    pairs = (parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(best)))
    return pairs.union(apart).select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))
