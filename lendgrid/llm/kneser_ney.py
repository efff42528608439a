"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

The model is over characters within words: a word is read with start marks
before it and an end mark behind it, so its probability depends on the word
alone and is computed once per distinct word. One model is made per language,
from every word of every trusted document. Counts, continuation counts,
contexts' totals and discounts are tables, sharded by n-gram, and the
probabilities follow order by order from joins of these tables.

A document's score is its perplexity per character, and the perplexity of its
tail: of the words, by falling perplexity, the one behind ``TAIL_SHARE`` of
them (the ``TAIL_LEAST``-th at least). The mean tells text of another kind, the
tail tells a few foreign words in text of the same kind. A second model crosses
word boundaries: a text is read as one letter a word, which says how far back
the same word stood last, whether it begins with a capital and whether it ends
with a mark, and n-grams of these letters have their perplexity per word. It
tells repeated and shuffled words, each of which may be ordinary. A third model
is of words again, from text labelled toxic and otherwise good: foul words of a
language are made like its others, so that trusted text alone does not tell
them. The log of a word's probability by a mixture of both over that by the
trusted model is its toxicity, a document's is the mean of its ``FOUL_SHARE``
most toxic words.

Every document is scored by models that have not read it: labelled texts are
dealt into two halves by their hash, and a document meets the models of the
half it would not be in. So all trusted documents both train and set limits,
which are their language's quantiles; the limit of toxicity lies where it
catches all but ``FOUL_MISSED`` of the documents labelled toxic, but rejects
at most 1 - ``FOUL_QUANTILE`` of the trusted ones.

A text is scored by the models of its language and half alone. So models are
broadcast some languages and halves at a time, at most ``MOST_ENTRIES`` rows
together, which bounds what reaches the driver and a worker; each such pass
reads the documents again and scores its own, and nothing is shuffled. Where
the models of a language and half have more rows by themselves, its distinct
words meet the sharded model by joins, and its documents meet their words'
scores by another; the scores are the same.
"""

from __future__ import annotations

import math
import re
import uuid
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import cut, ship_package

ORDER = 5
START, END = "\x02", "\x03"
#: Model keys are languages; those of the letters for words, and those of toxic text, have this before the language.
TURNS, TOXIC = "\x04", "\x05"
#: Words that an n-gram of such letters spans, and the letters: distances by powers of two up to LONGEST_TURN, by four shapes, after the start mark.
TURN_ORDER, LONGEST_TURN = 3, 8
LETTERS = START + "".join(chr(0x100 + i) for i in range(4 * (LONGEST_TURN + 1)))
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Rows of the models that are broadcast together (24 bytes each in a worker: hash, probability, weight).
MOST_ENTRIES = 3_000_000
#: Parts in which such a model comes to the driver.
MODEL_PARTS = 16
TAIL_SHARE, TAIL_LEAST = 0.012, 2
#: Quantiles of the trusted documents' scores.
MEAN_QUANTILE, TAIL_QUANTILE, TURN_QUANTILE, FOUL_QUANTILE = 0.995, 0.99, 0.995, 0.95
#: Share of the documents labelled toxic that their limit may miss.
FOUL_MISSED = 0.03
#: The most toxic words of a text (share, least number), and the toxic model's weight in the mixture.
FOUL_SHARE, FOUL_LEAST, FOUL_WEIGHT = 0.03, 2, 0.2
#: Log ratio at which a word counts as toxic beyond doubt.
MOST_FOUL = 50.0
#: A text at the toxic documents' quantile is itself above the limit.
SLACK = 1e-9
#: Bits of the filter that tells texts without a label.
LABEL_BITS = 1 << 24
#: Words whose counts a worker holds before it passes them on, and whose scores it holds, of each language and half, before it forgets them.
HELD_WORDS, SCORED_WORDS = 200_000, 50_000
#: Words whose n-grams are numbered together.
GRAM_WORDS = 1 << 15
#: Words whose numbers a worker holds before it scores their texts.
BATCH_WORDS = 1 << 17


def texts_of(docs: DataFrame) -> DataFrame:
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                       F.xxhash64(text).alias("text_hash"), text.alias("text"))


def word_shape(word: str) -> int:
    """Whether a word begins with a capital (2), and whether it ends with a mark (1)."""
    return 2 * word[0].isupper() + (not word[-1].isalnum())


class WordIds(dict):
    """word -> a number of its own, by which its shape is found."""

    def __init__(self):
        super().__init__()
        self.shapes = array("b")

    def __missing__(self, word: str) -> int:
        self.shapes.append(word_shape(word))
        self[word] = number = len(self)
        return number

    def ids(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def clear(self) -> None:
        super().clear()
        self.shapes = array("b")


def turn_codes(ids: np.ndarray, shapes: array) -> np.ndarray:
    """For every word of a text the n-gram of letters that ends with it, as a number to the base of the letters."""
    order = np.argsort(ids, kind="stable")
    again = ids[order[1:]] == ids[order[:-1]]
    back = np.zeros(len(ids), np.int64)
    back[order[1:][again]] = (order[1:] - order[:-1])[again]
    letters = np.minimum(np.frexp(back)[1], LONGEST_TURN).astype(np.int64) * 4 + np.frombuffer(shapes, np.int8)[ids] + 1
    padded = np.concatenate([np.zeros(TURN_ORDER - 1, np.int64), letters])
    code = np.zeros(len(ids), np.int64)
    for i in range(TURN_ORDER):
        code = code * len(LETTERS) + padded[i : i + len(ids)]
    return code


def turn_gram(code: int) -> str:
    return "".join(LETTERS[code // len(LETTERS) ** i % len(LETTERS)] for i in range(TURN_ORDER - 1, -1, -1))


def word_grams(words: dict[str, int], order: int) -> tuple[list[str], np.ndarray]:
    """The n-grams of ``order`` characters of all words with their marks, and how often each occurs."""
    if not words:
        return [], np.zeros(0, np.int64)
    text = "".join(START * (order - 1) + w + END for w in words)
    places = np.fromiter(map(len, words), np.int64, len(words)) + 1
    lengths = places + order - 1
    begins = np.repeat(np.cumsum(lengths) - lengths - (np.cumsum(places) - places), places) + np.arange(places.sum())
    points = code_points(text).astype(np.int64)
    used = np.zeros(points.max() + 1, bool)
    used[points] = True
    rank, base = (np.cumsum(used) - 1)[points], int(used.sum())  # characters as small numbers
    code = rank[begins]
    for i in range(1, order):
        if (int(code.max()) + 1) * base >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
        code = code * base + rank[begins + i]
    by = np.argsort(code)
    ordered = code[by]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    n = np.add.reduceat(np.repeat(np.fromiter(words.values(), np.int64, len(words)), places)[by], first)
    return [text[b : b + order] for b in begins[by[first]].tolist()], n


def ngram_counts(texts: DataFrame, order: int, turns: bool = False) -> DataFrame:
    """(lang, gram, n): how often each n-gram of ``order`` characters occurs in all words,
    and with ``turns`` each of TURN_ORDER letters for words, under TURNS + lang."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        coded: dict[str, np.ndarray] = {}
        waiting: dict[str, list[np.ndarray]] = {}
        numbers = WordIds()

        def add_up() -> None:
            for lang, codes in waiting.items():
                coded[lang] = coded.get(lang, 0) + np.bincount(np.concatenate(codes), minlength=len(LETTERS) ** TURN_ORDER)
            waiting.clear()

        def rows(lang: str, grams: list[str], n) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(n, pa.int64())], ["lang", "gram", "n"])

        def grams() -> Iterator[pa.RecordBatch]:
            add_up()
            found = {TURNS + lang: Counter({turn_gram(c): int(n[c]) for c in np.flatnonzero(n).tolist()}) for lang, n in coded.items()}
            for lang, n in found.items():
                yield rows(lang, list(n), list(n.values()))
            for lang, words in held.items():
                total, items = Counter(), iter(words.items())
                while part := dict(islice(items, GRAM_WORDS)):
                    for gram, n in zip(*word_grams(part, order)):
                        total[gram] += int(n)
                yield rows(lang, list(total), list(total.values()))
            held.clear(), coded.clear(), numbers.clear()

        n_waiting = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = WORD.findall(text.as_py())
                held.setdefault(lang, Counter()).update(words)
                if turns and words and not lang.startswith(TOXIC):
                    waiting.setdefault(lang, []).append(turn_codes(numbers.ids(words), numbers.shapes))
                    n_waiting += len(words)
                    if n_waiting > BATCH_WORDS:
                        add_up()
                        n_waiting = 0
                if sum(map(len, held.values())) > HELD_WORDS:
                    yield from grams()
                    n_waiting = 0
        yield from grams()

    return texts.select("lang", "text").mapInArrow(run, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def discount(j: int, counts: str = "n") -> Column:
    """Discount of an n-gram seen ``j`` times (3: or more), from the counts of counts."""
    n = [F.greatest(F.col(f"{counts}{i}"), F.lit(1)).cast("double") for i in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1])
    return F.greatest(F.lit(0.1 * j), F.least(F.lit(0.95 * j), F.lit(j) - (j + 1) * y * n[j] / n[j - 1]))


def model(counts: DataFrame, order: int) -> DataFrame:
    """(lang, k, gram, logp, bow): for every n-gram seen, of 1 to ``order`` characters,
    its interpolated log probability, and the log weight by which the next lower
    order counts after it (null where it was never a context). The empty one has
    the probability of a character never seen."""
    n = F.length("gram")
    # Continuation counts: how many different characters come before an n-gram.
    suffixes = counts.select("lang", F.explode(F.sequence(F.lit(2), F.lit(order))).alias("k"), "gram").select(
        "lang", (F.col("k") - 1).alias("k"), F.expr("right(gram, k)").alias("gram")).distinct()
    continuations = suffixes.groupBy("lang", "k", F.substr("gram", F.lit(2)).alias("gram")).agg(F.count("*").alias("c"))
    seen = cut(counts.select("lang", F.lit(order).alias("k"), "gram", F.col("n").alias("c")).union(continuations), "kn-counts", free=True)
    discounts = seen.groupBy("lang", "k").agg(*(F.count_if(F.col("c") == j).alias(f"n{j}") for j in range(1, 5)), F.count("*").alias("types")).select(
        "lang", "k", "types", *(discount(j).alias(f"d{j}") for j in range(1, 4)))
    seen = seen.withColumn("context", F.expr("left(gram, k - 1)"))
    contexts = (seen.groupBy("lang", "k", "context")
                .agg(F.sum("c").alias("total"), *(F.count_if(F.least("c", F.lit(3)) == j).alias(f"m{j}") for j in range(1, 4)))
                .join(discounts, ["lang", "k"])
                .withColumn("lower", sum((F.col(f"d{j}") * F.col(f"m{j}") for j in range(1, 4)), F.lit(0.0)) / F.col("total")))
    taken = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    parts = cut(seen.join(contexts, ["lang", "k", "context"]).select(
        "lang", "k", "gram", "context", "lower", "types", (F.greatest(F.col("c") - taken, F.lit(0.0)) / F.col("total")).alias("own")), "kn-parts", free=True)
    # Each order is written before the next one reads it: as one plan, the driver holds every lower order anew under each higher one.
    p = cut(parts.filter("k = 1").select("lang", "k", "gram", (F.col("own") + F.col("lower") / (F.col("types") + 1)).alias("p")), "kn-orders", free=True)
    every = [p]
    for k in range(2, order + 1):
        below = p.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("p_below"))
        p = cut(parts.filter(F.col("k") == k).withColumn("suffix", F.substr("gram", F.lit(2))).join(below, ["lang", "suffix"])
                .select("lang", "k", "gram", (F.col("own") + F.col("lower") * F.col("p_below")).alias("p")), "kn-orders", free=True)
        every.append(p)
    probabilities = every[0]
    for p in every[1:]:
        probabilities = probabilities.union(p)
    bows = parts.select("lang", F.col("context").alias("gram"), F.log("lower").alias("bow"), "types").distinct()
    empty = bows.filter("gram = ''").select("lang", F.lit(0).alias("k"), "gram", F.log(1 / (F.col("types") + 1)).alias("logp"), "bow")
    # Contexts of start marks alone are no n-grams: they have a weight and no probability.
    return (probabilities.join(bows.filter("gram != ''").drop("types"), ["lang", "gram"], "full").select("lang", "k", "gram", F.log("p").alias("logp"), "bow")
            .union(empty).withColumn("k", n.cast("int")))


_FACTORS = np.random.default_rng(20240611).integers(1 << 32, 1 << 63, size=64, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def ending_hashes(points: np.ndarray, order: int) -> list[np.ndarray]:
    """By length from 0 to ``order``: the hash of the n-gram that ends with each character
    (of those that reach before the first one, a value without meaning)."""
    spread, total = mix(points + np.uint64(1)), np.zeros(len(points), np.uint64)
    found = [mix(total)]
    for k in range(1, order + 1):
        total = total.copy()
        total[k - 1 :] += spread[: len(points) - k + 1] * _FACTORS[k - 1]
        found.append(mix(total + np.uint64(k)))
    return found


def gram_hashes(grams: list[str]) -> np.ndarray:
    """The hash of each n-gram, as ``ending_hashes`` has it."""
    lengths = np.fromiter(map(len, grams), np.int64, len(grams))
    found = np.zeros(len(grams), np.uint64)
    for k in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == k)
        if k == 0:
            found[at] = mix(np.zeros(1, np.uint64))
            continue
        found[at] = ending_hashes(code_points("".join(grams[i] for i in at)), k)[k][k - 1 :: k]
    return found


class Entries:
    """The n-grams of a model, sorted by hash.

    As hashes are spread evenly, the first bits of one say where it is: ``first`` has the
    place of the first hash with these bits, and few places follow that have them too."""

    def __init__(self, keys: np.ndarray, logp: np.ndarray, bow: np.ndarray):
        if not (keys[1:] >= keys[:-1]).all():
            order = np.argsort(keys)
            keys, logp, bow = keys[order], logp[order], bow[order]
        self.keys, self.logp, self.bow = keys, logp, bow  # a weight is NaN where the n-gram was never a context
        bits = max(1, len(keys).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.keys, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether it is there) of each hash."""
        last = len(self.keys) - 1
        at = np.minimum(self.first[(keys >> self.shift).astype(np.int64)], last)
        met = self.keys[at]
        there, go_on = met == keys, np.flatnonzero(met < keys)
        while len(go_on):
            go_on = go_on[at[go_on] < last]
            at[go_on] += 1
            met = self.keys[at[go_on]]
            own = keys[go_on]
            there[go_on] = met == own
            go_on = go_on[met < own]
        return at, there

    def losses(self, units: list[str], order: int) -> np.ndarray:
        """For each unit the negative log probability of what follows its first ``order`` - 1 characters."""
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        hashes = ending_hashes(code_points("".join(units)), order)
        first = np.cumsum(lengths) - lengths
        places = lengths - (order - 1)
        begins = np.cumsum(places) - places
        open_ = np.arange(places.sum()) + np.repeat(first + order - 1 - begins, places)
        total = np.zeros(lengths.sum())
        for k in range(order, -1, -1):
            at, there = self.find(hashes[k][open_])
            there &= ~np.isnan(self.logp[at])
            total[open_[there]] += self.logp[at[there]]
            open_ = open_[~there]
            if not len(open_) or not k:
                break
            at, there = self.find(hashes[k - 1][open_ - 1])
            total[open_[there]] += np.nan_to_num(self.bow[at[there]])
        return -np.add.reduceat(total, first)


class WordScores(WordIds):
    """word -> its number, by which its negative log probability, its characters with the end mark and its toxicity are found.

    When it is full, its words become the old generation: one that is met again is taken over with
    its scores, so that only words not met for a whole generation are scored again."""

    def __init__(self, entries: Entries, order: int, turns: Entries | None, toxic: Entries | None):
        super().__init__()
        self.entries, self.order, self.turns, self.toxic = entries, order, turns, toxic
        self.losses, self.chars, self.foul = array("d"), array("q"), array("d")
        self.new: list[str] = []
        self.old = ({}, self.losses, self.chars, self.foul, self.shapes)
        self.turn_losses = np.full(len(LETTERS) ** TURN_ORDER, np.nan)

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = number = len(self)
        return number

    def learn(self) -> None:
        """The scores of the words met since the last call: those of the old generation, and new ones."""
        if not self.new:
            return
        known = np.fromiter(map(self.old[0].get, self.new, repeat(-1)), np.int64, len(self.new))
        losses, chars, foul, shapes = (np.zeros(len(known), t) for t in (np.float64, np.int64, np.float64, np.int8))
        met, at = np.flatnonzero(known >= 0), np.flatnonzero(known < 0)
        if len(met):
            for values, old in zip((losses, chars, foul, shapes), self.old[1:]):
                values[met] = np.frombuffer(old, values.dtype)[known[met]]
        if len(at):
            words = [self.new[i] for i in at.tolist()]
            marked = [START * (self.order - 1) + w + END for w in words]
            losses[at] = self.entries.losses(marked, self.order)
            chars[at] = np.fromiter(map(len, words), np.int64, len(words)) + 1
            shapes[at] = [word_shape(w) for w in words]
            if self.toxic:
                ratio = np.minimum(losses[at] - self.toxic.losses(marked, self.order), MOST_FOUL)
                foul[at] = np.log(1 - FOUL_WEIGHT + FOUL_WEIGHT * np.exp(ratio))
        for held, values in zip((self.losses, self.chars, self.foul, self.shapes), (losses, chars, foul, shapes)):
            held.frombytes(values.tobytes())
        self.new = []

    def forget(self) -> None:
        self.old = (dict(self), self.losses, self.chars, self.foul, self.shapes)
        self.clear()
        self.losses, self.chars, self.foul = array("d"), array("q"), array("d")

    def of_text(self, ids: np.ndarray) -> tuple[float, float, float | None, float | None]:
        """(mean, tail, turn, foul) of a text that has words, by their numbers."""
        losses, chars, n = np.frombuffer(self.losses)[ids], np.frombuffer(self.chars, np.int64)[ids], len(ids)
        per, k, turn, foul = losses / chars, n - tail_rank(n), None, None
        if self.toxic:
            k_foul = n - foul_words(n)
            foul = float(np.partition(np.frombuffer(self.foul)[ids], min(k_foul, n - 1))[k_foul:].mean())
        if self.turns:
            codes = turn_codes(ids, self.shapes)
            if len(unknown := np.unique(codes[np.isnan(self.turn_losses[codes])])):
                self.turn_losses[unknown] = self.turns.losses([turn_gram(c) for c in unknown.tolist()], TURN_ORDER)
            turn = float(self.turn_losses[codes].mean())
        return float(losses.sum() / chars.sum()), float(np.partition(per, k)[k]), turn, foul


_scores: dict[str, dict[str, WordScores]] = {}


def word_scores(number: str, shared, order: int) -> dict[str, WordScores]:
    """The scores of each language from a broadcast model, read once per worker;
    a worker keeps the last model alone."""
    if number not in _scores:
        _scores.clear()
        of_lang: dict[str, Entries] = {}
        for lang, data in shared.value.items():
            key, logp, bow = np.frombuffer(data, np.int64).reshape(3, -1)
            of_lang[lang] = Entries(key.view(np.uint64), logp.view(np.float64), bow.view(np.float64))
        _scores[number] = {lang: WordScores(e, order, of_lang.get(TURNS + lang), of_lang.get(TOXIC + lang))
                           for lang, e in of_lang.items() if not lang.startswith((TURNS, TOXIC))}
    return _scores[number]


def foul_words(n: int) -> int:
    """How many words, by falling toxicity, are the toxicity of a text of ``n`` words."""
    return min(n, max(FOUL_LEAST, math.ceil(FOUL_SHARE * n)))


def tail_rank(n: int) -> int:
    """Which word, by falling perplexity, is the tail of a text of ``n`` words."""
    return min(n, max(TAIL_LEAST, math.ceil(TAIL_SHARE * n)))


SCORES = "doc_id long, text_hash long, lang string, n_words long, mean double, tail double, turn double, foul double"


def broadcast_model(entries: DataFrame) -> Broadcast:
    """The rows of a model, by language and in order of their hashes."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row a batch and language: the hashes, log probabilities and weights one behind the other."""
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            lang, keys = names.indices.to_numpy(), gram_hashes(batch.column(1).to_pylist())
            values = [keys.view(np.int64), *(batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in (2, 3))]
            data = [b"".join(v[lang == i].tobytes() for v in values) for i in range(len(names.dictionary))]
            yield pa.RecordBatch.from_arrays([names.dictionary, pa.array(data, pa.binary())], ["lang", "data"])

    # At most 24 bytes for each of ``most_entries`` rows, on the driver and in a worker; they come a part after the other.
    rows = entries.select("lang", "gram", "logp", "bow").coalesce(MODEL_PARTS).mapInArrow(packed, "lang string, data binary")
    parts: dict[str, list[np.ndarray]] = {}
    for row in rows.toLocalIterator():
        parts.setdefault(row["lang"], []).append(np.frombuffer(bytes(row["data"]), np.int64).reshape(3, -1))
    # In order of the hashes, so that a worker reads them where they are.
    blobs = {}
    while parts:
        lang, found = parts.popitem()
        whole = np.concatenate(found, axis=1)
        blobs[lang] = whole[:, np.argsort(whole[0].view(np.uint64))].tobytes()
    return entries.sparkSession.sparkContext.broadcast(blobs)


def scores_by_broadcast(texts: DataFrame, entries: DataFrame, order: int, shared: Broadcast | None = None) -> DataFrame:
    """SCORES of every row, log perplexities per character (turn: per word), and the toxicity."""
    shared = shared or broadcast_model(entries)
    number = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = word_scores(number, shared, order)

        def judged(rows: pa.RecordBatch, found: list[tuple[str, np.ndarray]]) -> pa.RecordBatch:
            for of_lang in scores.values():
                of_lang.learn()
            out = [(len(ids), *(scores[lang].of_text(ids) if len(ids) and lang in scores else (None,) * 4)) for lang, ids in found]
            for of_lang in scores.values():
                if len(of_lang) >= SCORED_WORDS:
                    of_lang.forget()
            n_words, *values = zip(*out)
            return pa.RecordBatch.from_arrays([*(rows.column(i) for i in range(3)), pa.array(n_words, pa.int64()), *(pa.array(c, pa.float64()) for c in values)],
                                              ["doc_id", "text_hash", "lang", "n_words", "mean", "tail", "turn", "foul"])

        for batch in batches:
            found, first, held = [], 0, 0
            for i, (lang, text) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3))):
                words = WORD.findall(text.as_py())
                found.append((lang, scores[lang].ids(words) if lang in scores else np.zeros(len(words), np.int64)))
                held += len(words)
                if held > BATCH_WORDS:
                    yield judged(batch.slice(first, i + 1 - first), found)
                    found, first, held = [], i + 1, 0
            if found:
                yield judged(batch.slice(first), found)

    return texts.select("doc_id", "text_hash", "lang", "text").mapInArrow(run, SCORES)


def scores_by_join(texts: DataFrame, entries: DataFrame, order: int) -> DataFrame:
    """The same scores from joins alone: rows -> their words and n-grams of letters -> these units' n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc_id, text_hash, lang, text in zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4)):
                words, numbers = WORD.findall(text.as_py()), WordIds()
                counts = Counter(words)
                codes, times = np.unique(turn_codes(numbers.ids(words), numbers.shapes), return_counts=True) if words else ([], np.zeros(0, np.int64))
                # The first unit stands for the row itself.
                units = [None, *(START * (order - 1) + w + END for w in counts), *map(turn_gram, map(int, codes))]
                n = [len(words), *counts.values(), *times.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(n), pa.int64()), pa.array([doc_id] + [None] * (len(n) - 1), pa.int64()), pa.array([text_hash] + [None] * (len(n) - 1), pa.int64()),
                     pa.array([lang] * len(n), pa.string()), pa.array([None] + [False] * len(counts) + [True] * len(codes), pa.bool_()), pa.array(units, pa.string()), pa.array(n, pa.int64())],
                    ["row", "doc_id", "text_hash", "lang", "turns", "unit", "n"])

    # One table of all units: the row numbers are given once.
    units = cut(texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text_hash", "lang", "text").mapInArrow(
        run, "row long, doc_id long, text_hash long, lang string, turns boolean, unit string, n long"), "kn-units")
    rows = units.filter("unit is null").select("row", "doc_id", "text_hash", "lang", F.col("n").alias("n_words"))
    model_of = F.when(F.col("turns"), F.concat(F.lit(TURNS), "lang")).otherwise(F.col("lang"))
    counted = units.filter("unit is not null").select("row", model_of.alias("lang"), "turns", "unit", "n")
    asking = counted.select("lang", "turns", "unit").distinct()
    asking = asking.union(asking.filter("not turns").withColumn("lang", F.concat(F.lit(TOXIC), "lang")))
    places = (asking.select("lang", "unit", F.when(F.col("turns"), TURN_ORDER).otherwise(order).alias("most"))
              .join(entries.select("lang").distinct(), "lang", "left_semi")
              .select("*", F.explode(F.expr("sequence(1, length(unit) - most + 1)")).alias("at")))
    # Every place asks all orders; the longest n-gram seen counts, and the weights of the contexts above it.
    asked = places.select("lang", "unit", "at", F.explode(F.expr("sequence(0, most)")).alias("k"), "most").withColumn(
        "gram", F.expr("substring(unit, at + most - k, k)")).withColumn("context", F.expr("substring(unit, at + most - k, greatest(k - 1, 0))"))
    known = asked.join(entries.select("lang", "gram", "logp"), ["lang", "gram"], "left").join(
        entries.select("lang", F.col("gram").alias("context"), "bow"), ["lang", "context"], "left")
    longest = known.withColumn("longest", F.max(F.when(F.col("logp").isNotNull(), F.col("k"))).over(Window.partitionBy("lang", "unit", "at")))
    term = F.when(F.col("k") == F.col("longest"), F.col("logp")).when(F.col("k") > F.col("longest"), F.coalesce("bow", F.lit(0.0))).otherwise(0.0)
    of_unit = longest.groupBy("lang", "unit").agg((-F.sum(term)).alias("loss"))
    toxic = F.col("lang").startswith(TOXIC)
    of_unit = (of_unit.groupBy(F.when(toxic, F.substr("lang", F.lit(len(TOXIC) + 1))).otherwise(F.col("lang")).alias("lang"), "unit")
               .agg(F.max(F.when(~toxic, F.col("loss"))).alias("loss"), F.max(F.when(toxic, F.col("loss"))).alias("toxic_loss")).filter("loss is not null"))
    met = counted.join(of_unit, ["lang", "unit"])
    turn = met.filter("turns").groupBy("row").agg((F.sum(F.col("loss") * F.col("n")) / F.sum("n")).alias("turn"))
    before = Window.partitionBy("row").orderBy(F.desc(F.col("loss") / F.col("chars")), "unit").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("row")
    ranked = met.filter("not turns").withColumn("chars", F.length("unit") - (order - 1)).withColumn("n_words", F.sum("n").over(whole)).withColumn("upto", F.sum("n").over(before)).withColumn(
        "k", F.least("n_words", F.greatest(F.lit(TAIL_LEAST), F.ceil(F.lit(TAIL_SHARE) * F.col("n_words")))))
    most = F.least("n_words", F.greatest(F.lit(FOUL_LEAST), F.ceil(F.lit(FOUL_SHARE) * F.col("n_words"))))
    first = Window.partitionBy("row").orderBy(F.desc("foul"), "unit").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (ranked.withColumn("foul", F.log(1 - FOUL_WEIGHT + FOUL_WEIGHT * F.exp(F.least(F.col("loss") - F.col("toxic_loss"), F.lit(MOST_FOUL)))))
              .withColumn("foul", F.when(F.col("toxic_loss").isNotNull(), F.col("foul"))).withColumn("most", most)
              .withColumn("among", F.greatest(F.lit(0), F.least("n", F.col("most") - F.sum("n").over(first) + F.col("n")))))
    scored = ranked.groupBy("row").agg(
        (F.sum(F.col("foul") * F.col("among")) / F.max("most")).alias("foul"),
        (F.sum(F.col("loss") * F.col("n")) / F.sum(F.col("chars") * F.col("n"))).alias("mean"),
        F.max(F.when(F.col("upto") >= F.col("k"), F.col("loss") / F.col("chars"))).alias("tail"))
    return rows.join(scored, "row", "left").join(turn, "row", "left").select("doc_id", "text_hash", "lang", "n_words", "mean", "tail", "turn", "foul")


def passes(sizes: dict[str, int], most_entries: int) -> tuple[list[list[str]], list[str]]:
    """The keys of texts whose models have at most ``most_entries`` rows together, by first fit
    from the largest on, and those whose models have more by themselves."""
    found, rows, alone = [], [], []
    for key, n in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        if n > most_entries:
            alone.append(key)
            continue
        i = next((i for i, held in enumerate(rows) if held + n <= most_entries), len(rows))
        if i == len(rows):
            found.append([])
            rows.append(0)
        found[i].append(key)
        rows[i] += n
    return found, alone


def written_scores(texts: DataFrame, entries: DataFrame, order: int, most_entries: int) -> DataFrame:
    """SCORES of every row, as written tables. The first pass has the texts without a model too."""
    key = F.when(F.col("lang").startswith(TURNS) | F.col("lang").startswith(TOXIC), F.substr("lang", F.lit(2))).otherwise(F.col("lang"))
    # One row a language and half.
    shared_by, alone = passes({x["key"]: x["n"] for x in entries.groupBy(key.alias("key")).agg(F.count("*").alias("n")).collect()}, most_entries)
    shared_by = shared_by or [[]]
    later = [k for keys in shared_by[1:] for k in keys] + alone
    found = []
    for i, keys in enumerate(shared_by):
        # Texts of a half and language read the models of these alone.
        own, of_own = (texts, entries) if not later else (texts.filter(F.col("lang").isin(keys) if i else ~F.col("lang").isin(later)), entries.filter(key.isin(keys)))
        shared = broadcast_model(of_own)
        found.append(cut(scores_by_broadcast(own, of_own, order, shared), "kn-scores"))
        shared.destroy()  # the written scores need it no more
    if alone:
        found.append(cut(scores_by_join(texts.filter(F.col("lang").isin(alone)), entries.filter(key.isin(alone)), order), "kn-scores"))
    return reduce(DataFrame.union, found)


def classify(docs: DataFrame, labels: DataFrame, order: int = ORDER, most_entries: int = MOST_ENTRIES) -> DataFrame:
    """(doc_id, text_hash, lang, n_words, trusted, perplexity, tail_perplexity, turn_perplexity, toxicity,
    max_perplexity, max_tail_perplexity, max_turn_perplexity, max_toxicity, kept) of every row of ``docs``.

    Trusted are the rows whose doc_id has labels, all of them of quality 1 and not
    toxic (a null label is neither); toxic text is that whose labels are all of
    quality 1 and one of them toxic. ``text_hash`` (xxhash64 of the text) tells rows
    apart that share a doc_id. A null text has no words; rows without words
    and rows of a language without trusted text have no perplexity and are kept, as
    nothing speaks against them. If all trusted text of a language is in one half, its
    models score that half too, and the limits are in-sample (stricter than others). A language without toxic text in both halves has
    no limit of toxicity. A null lang is a language of its own; a null
    doc_id is never trusted; a repeated row is judged again; empty tables give an
    empty table or no trusted text; columns other than doc_id, text, lang and
    those of the labels are not read.
    """
    good = (labels.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.min((F.col("quality") == 1).cast("int")).alias("good"), F.count_if(F.col("quality").isNull()).alias("unknown"),
                 F.max((F.coalesce("toxic", F.lit(0)) != 0)).alias("toxic"))
            .filter("good = 1 and unknown = 0 and doc_id is not null").select("doc_id", "toxic"))
    # The key of the models that score a text: its half and its language. A labelled text trains those of the other half.
    half = F.pmod(F.xxhash64("text_hash"), F.lit(2))
    texts = texts_of(docs).withColumn("lang", F.concat(half.cast("string"), "lang"))
    trains = F.concat((1 - half).cast("string"), F.substr("lang", F.lit(2)))
    # Texts without a label are told by one bit of their id's hash before any text is shuffled: LABEL_BITS bits
    # in words of 64, a table of fixed size. The rest meets the labels by a merge join, as these grow with the documents.
    bit_of = F.pmod(F.xxhash64("doc_id"), F.lit(LABEL_BITS))
    label_bits = (good.select(F.shiftright(bit_of, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {LABEL_BITS}L) & 63 as int))").alias("bit"))
                  .groupBy("word").agg(F.bit_or("bit").alias("bits")))
    maybe = (texts.withColumn("word", F.shiftright(bit_of, 6)).join(F.broadcast(label_bits), "word")
             .filter(F.expr(f"shiftrightunsigned(bits, cast(pmod(xxhash64(doc_id), {LABEL_BITS}L) & 63 as int)) & 1 = 1")).drop("word", "bits"))
    training = maybe.join(good.hint("merge"), "doc_id").withColumn("lang", F.concat(F.when(F.col("toxic"), TOXIC).otherwise(""), trains))
    counts = cut(ngram_counts(training, order, turns=True), "kn-ngrams", free=True)
    # A language with trusted text in one half alone: its models score both.
    of_turns, of_toxic = F.col("lang").startswith(TURNS), F.col("lang").startswith(TOXIC)
    key = F.when(of_turns, F.substr("lang", F.lit(len(TURNS) + 1))).otherwise(F.col("lang"))
    of_trusted = counts.filter(~of_toxic).select(F.substr(key, F.lit(2)).alias("name"), F.substr(key, F.lit(1), F.lit(1)).alias("half"), of_turns.alias("turns"), "gram", "n")
    alone = of_trusted.filter("not turns").groupBy("name").agg(F.count_distinct("half").alias("halves")).filter("halves = 1").select("name")
    other = F.concat(F.when(F.col("turns"), TURNS).otherwise(""), F.when(F.col("half") == "0", "1").otherwise("0"), "name")
    counts = counts.union(of_trusted.join(alone, "name").select(other.alias("lang"), "gram", "n"))
    entries = cut(model(counts.filter(~of_turns), order).union(model(counts.filter(of_turns), TURN_ORDER)), "kn-model", free=True)
    scored = written_scores(texts, entries, order, most_entries).withColumn("lang", F.substr("lang", F.lit(2)))
    marked = cut(scored.join(good, "doc_id", "left").withColumn("trusted", F.coalesce(~F.col("toxic"), F.lit(False))), "kn-marked")

    def quantile(score: str, of: Column, share: float) -> Column:
        return F.percentile_approx(F.when(of, F.col(score)), F.lit(share), F.lit(10_000))

    trusted = F.col("trusted")
    limits = marked.filter(F.col("toxic").isNotNull()).groupBy("lang").agg(
        F.exp(quantile("mean", trusted, MEAN_QUANTILE)).alias("max_perplexity"),
        F.exp(quantile("tail", trusted, TAIL_QUANTILE)).alias("max_tail_perplexity"),
        F.exp(quantile("turn", trusted, TURN_QUANTILE)).alias("max_turn_perplexity"),
        quantile("foul", trusted, FOUL_QUANTILE).alias("most_trusted"), quantile("foul", ~trusted, FOUL_MISSED).alias("least_toxic"))
    # One row a language, written so that its size is known: Spark broadcasts it if it is small, and scores are not dealt by language.
    limits = cut(limits.withColumn("max_toxicity", F.when(F.col("least_toxic").isNotNull(), F.greatest("most_trusted", F.col("least_toxic") - SLACK))), "kn-limits")
    scores = {"perplexity": F.exp("mean"), "tail_perplexity": F.exp("tail"), "turn_perplexity": F.exp("turn"), "toxicity": F.col("foul")}
    judged = marked.join(limits, "lang", "left").withColumns(scores)
    kept = F.lit(True)
    for name in scores:
        kept = kept & F.coalesce(F.col(name) <= F.col(f"max_{name}"), F.lit(True))
    return judged.select("doc_id", "text_hash", "lang", "n_words", "trusted", *scores, *(f"max_{name}" for name in scores), kept.alias("kept"))


def keep_accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, that :func:`classify` keeps."""
    bad = classify(docs, labels).filter("not kept").select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct()
    own = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["bad_id"]) & (own == bad["bad_hash"]), "left_anti")
