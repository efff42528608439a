"""Quality rules with thresholds that follow the data of each language and source.

Base counts come from the whole text, by DataFrame functions alone. Four ratios
made of them (and the mean word length, both ways) are then held against fences of
their own group of documents, a language in a source. A fence comes from the group's
quantiles, which are read from a mergeable sketch: a ratio's values are counted in
bins whose bounds grow by a fixed factor, so a quantile is known to a fixed relative
error, and sketches are merged by adding up counts. Unlike sketches that drop values
at random, the result depends neither on the order of rows nor on how they are
dealt: the same table has the same verdicts in every run. Documents meet their group's
fences by a join, so no cutoff is fixed for all.

A fence is ``center +- REACH * max(spread, least)``, with the group's median as
center, the distance between its lower and upper quartile as spread, and
``least`` the spread below which differences of that ratio say nothing. A group's
fences are drawn towards its language's, as if the language had ``PRIOR_DOCS``
documents in the group, so that a few documents do not set fences of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import cut

#: The white space that ends a word.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: ratio -> (least spread, lower fence applies)
RATIOS = {"mean_word_chars": (0.4, True), "symbol_ratio": (0.02, False), "dup_line_ratio": (0.12, False), "repeat_word_ratio": (0.08, False)}
#: Spreads between the center and the fence.
REACH = 4.0
#: Bounds of the sketch's bins grow by this factor, so a quantile is off by half a percent at most.
GROWTH = 1.01
#: Bin of the values below LEAST_VALUE, which are read as zero.
ZERO_BIN, LEAST_VALUE = -100_000, 1e-6
#: Weight of a language's fences in those of a group, in documents.
PRIOR_DOCS = 50


def words_of(text: Column) -> Column:
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[\\x20\\x09-\\x0D]+"))


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the base counts of every whole text (null: no words).

    n_repeat_words counts the words in 3-word windows that occur twice or more in
    the text: the windows' 64-bit hashes are sorted with their places, places
    whose hash has an equal neighbour are put in order, and each adds the words
    that the window before it did not have.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    rows = docs.select(
        "doc_id", F.coalesce(F.col("lang"), F.lit("")).alias("lang"), F.coalesce(F.col("source"), F.lit("")).alias("source"),
        words_of(text).alias("words"),
        F.length(without(text, SPACE)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        lines.alias("lines"))
    rows = rows.select("*", F.size("lines").cast("long").alias("n_lines"),
                       (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines")).drop("lines")
    n = F.size("words")
    rows = rows.withColumn("windows", F.when(n < 3, F.array().cast("array<struct<h:bigint,i:int>>")).otherwise(F.sort_array(
        F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(
            F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("h"), i.alias("i"))))))
    rows = rows.select("doc_id", "lang", "source", n.cast("long").alias("n_words"), "word_chars", "n_symbols", "n_lines", "n_dup_lines", "windows")
    def beside(x: Column, k: Column) -> Column:
        return F.coalesce(F.get("windows", k)["h"] == x["h"], F.lit(False))

    equal = F.filter("windows", lambda x, k: beside(x, k - 1) | beside(x, k + 1))
    rows = rows.withColumn("places", F.sort_array(F.transform(equal, lambda x: x["i"])))
    added = F.transform("places", lambda x, k: F.when(k == 0, F.lit(3)).otherwise(F.least(F.lit(3), x - F.get("places", k - 1))))
    return rows.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
                       F.aggregate(added, F.lit(0).cast("long"), lambda s, x: s + x).alias("n_repeat_words"))


def with_ratios(rows: DataFrame) -> DataFrame:
    words = F.greatest("n_words", F.lit(1)).cast("double")
    return rows.withColumns({
        "mean_word_chars": F.col("word_chars") / words,
        "symbol_ratio": F.col("n_symbols") / F.greatest("word_chars", F.lit(1)).cast("double"),
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)).cast("double"),
        "repeat_word_ratio": F.col("n_repeat_words") / words})


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, ratio, bin, n): how many documents of each language and source have a ratio in each bin."""
    bins = [F.struct(F.lit(r).alias("ratio"), F.when(F.col(r) < LEAST_VALUE, ZERO_BIN).otherwise(F.ceil(F.log(r) / F.log(F.lit(GROWTH)))).cast("long").alias("bin")) for r in RATIOS]
    return (rows.select("lang", "source", F.explode(F.array(*bins)).alias("b")).groupBy("lang", "source", "b.ratio", "b.bin")
            .agg(F.count("*").alias("n")))


def sketch_fences(counts: DataFrame, keys: list[str]) -> DataFrame:
    """The number of documents and the fences (``<ratio>_low``, ``<ratio>_high``) of each group of a sketch."""
    whole = Window.partitionBy(*keys, "ratio")
    placed = counts.select(*keys, "ratio", "bin", F.sum("n").over(whole).alias("n_docs"), F.sum("n").over(whole.orderBy("bin")).alias("upto"))
    at = placed.groupBy(*keys, "ratio", "n_docs").agg(*(F.min(F.when(F.col("upto") >= F.lit(p) * F.col("n_docs"), F.col("bin"))).alias(f"q{i}") for i, p in enumerate((0.25, 0.5, 0.75))))
    low, center, high = (F.when(F.col(f"q{i}") == ZERO_BIN, 0.0).otherwise(2 * F.pow(F.lit(GROWTH), F.col(f"q{i}")) / (GROWTH + 1)) for i in range(3))
    least = F.element_at(F.create_map(*(F.lit(x) for r, (spread, _) in RATIOS.items() for x in (r, spread))), F.col("ratio"))
    reach = F.lit(REACH) * F.greatest(high - low, least)
    sides = at.select(*keys, "ratio", "n_docs", (center - reach).alias("low"), (center + reach).alias("high"))
    return sides.groupBy(*keys).agg(F.max("n_docs").alias("n_docs"), *(F.max(F.when(F.col("ratio") == r, F.col(side))).alias(f"{r}_{side}") for r in RATIOS for side in ("low", "high")))


def fences(rows: DataFrame) -> DataFrame:
    """The fences of every language and source, drawn towards those of the language."""
    counts = cut(sketches(rows), "sketches")
    of_lang = sketch_fences(counts.groupBy("lang", "ratio", "bin").agg(F.sum("n").alias("n")), ["lang"]).drop("n_docs")
    names = [f"{r}_{side}" for r in RATIOS for side in ("low", "high")]
    both = sketch_fences(counts, ["lang", "source"]).join(of_lang.withColumnsRenamed({c: f"lang_{c}" for c in names}), "lang")
    return both.select("lang", "source", *(((F.col("n_docs") * F.col(c) + PRIOR_DOCS * F.col(f"lang_{c}")) / (F.col("n_docs") + PRIOR_DOCS)).alias(c) for c in names))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Base counts, ratios, fences' verdicts (``<ratio>_ok``), base_failed and kept of every row.

    A null text has no words and fails the base rules; a null lang or source is the
    empty one; a repeated row is judged again; a ratio at its fence is within it; texts of any
    length are counted whole, in one row; an empty table gives an empty table; columns other
    than doc_id, text, lang and source are not read. Fences are drawn from the documents that
    pass the base rules; where there are none, nothing is judged by them.
    """
    failed = (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))
    rows = cut(with_ratios(base_counts(docs)).withColumn("base_failed", failed), "base-counts")
    joined = rows.join(fences(rows.filter(~F.col("base_failed"))), ["lang", "source"], "left")
    within = {r: F.coalesce((F.col(r) <= F.col(f"{r}_high")) & ((F.col(r) >= F.col(f"{r}_low")) if both else F.lit(True)), F.lit(True))
              for r, (_, both) in RATIOS.items()}
    verdict = joined.select(*rows.columns, *(ok.alias(f"{r}_ok") for r, ok in within.items()))
    kept = ~F.col("base_failed")
    for r in RATIOS:
        kept = kept & F.col(f"{r}_ok")
    return verdict.withColumn("kept", kept)
