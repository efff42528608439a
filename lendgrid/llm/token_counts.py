"""Token counts of whole texts by a compiled finite-state transducer.

A SentencePiece BPE model whose pieces hold the space mark only at their front
(checked when the model is loaded) never joins characters across the place
where a space follows a non-space. Such a place is a *cut*: the transducer returns to
its first state there. Between cuts it reads character by character, and every transition is
annotated with the change it makes to the number of tokens.

The states come from two facts about BPE. The encoding of a string is the only sequence
of pieces that spells it in which every two neighbours are *valid*, that is, are
themselves the encoding of what they spell; so the encoding of a prefix is known from its
last piece and that of what lies before. And a piece that ends at the next character
begins within the longest suffix of what was read that begins any piece. A state is
therefore this suffix (a node of the pieces' prefix tree), with the last piece and the
number of tokens, relative to now, at each place in it where a piece can begin. There
are finitely many; states and arcs are numbered when they are first met, and found by one
look-up afterwards. The number of tokens of frequent segments is kept beside them.

Long texts are read in chunks. What a chunk does, as a map from the state
before it to the state after it and the tokens emitted, needs only three
things: its ``head`` up to the first cut, the tokens emitted between its first
and last cut, and its ``tail`` after the last cut. These maps compose
associatively, so the chunks of a text are evaluated independently and then
composed by a parallel prefix scan (:func:`scan`).
"""

from __future__ import annotations

import gc
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_text

MARK = "▁"
#: A run of spaces with the word behind it; a run of spaces at the end.
SEGMENT = re.compile("[ ]*[^ ]+|[ ]+")
CHUNK = 1 << 16
#: Segments up to so many characters have their number of tokens kept, so many in a worker; the table is emptied when it is full, which costs time only.
KEPT_CHARS, MOST_SEGMENTS = 48, 600_000
#: States, and pairs of pieces, that a worker keeps.
MOST_STATES, MOST_PAIRS = 300_000, 500_000


class Pieces:
    """The pieces of a BPE model by rank (0: joined before all others), and which pairs of them are valid.

    Pieces of equal score are joined from the left. Of a model only pieces that are joined from
    characters count; a character is never joined, so it has the rank -1."""

    def __init__(self, scores: dict[str, float]):
        best = {score: rank for rank, score in enumerate(sorted({x for piece, x in scores.items() if len(piece) > 1}, reverse=True))}
        self.ranks = {piece: best[score] if len(piece) > 1 else -1 for piece, score in scores.items()}
        self.prefixes = {piece[:i] for piece in scores for i in range(len(piece) + 1)}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.halves: dict[str, tuple[str, str] | None] = {}

    def encode(self, text: str) -> list[str]:
        """BPE as it is defined: the neighbours that spell the piece of the best rank are joined, the leftmost of equal ones."""
        symbols = list(text)
        while len(joins := [(self.ranks[x + y], i) for i, (x, y) in enumerate(zip(symbols, symbols[1:])) if x + y in self.ranks]):
            i = min(joins)[1]
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        return symbols

    def split(self, piece: str) -> tuple[str, str] | None:
        """The two pieces that are joined last when a piece is spelled; None if it is never made so."""
        if piece not in self.halves:
            symbols, found = list(piece), None
            while len(symbols) > 1 and (joins := [(self.ranks[x + y], i) for i, (x, y) in enumerate(zip(symbols, symbols[1:])) if x + y in self.ranks]):
                i = min(joins)[1]
                found = (symbols[i], symbols[i + 1])
                symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            self.halves[piece] = found if len(symbols) == 1 else None
        return self.halves[piece]

    def valid(self, left: str, right: str) -> bool:
        """Whether the two pieces are the encoding of what they spell. Their joins are undone, the last
        first: had there been a better join across their border at any time, it would have come before."""
        key = (left, right)
        if (known := self.pairs.get(key)) is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._valid(left, right)
        return known

    def _valid(self, left: str, right: str) -> bool:
        ranks, limit = self.ranks, float("inf")
        if left not in ranks or right not in ranks:  # a character that is no piece is spelled in bytes and joins nothing
            return True
        while True:
            across = ranks.get(left + right)
            if across is not None and across < limit:
                return False
            if ranks[left] > ranks[right]:
                halves, limit = self.split(left), ranks[left]
                left = halves[1] if halves else left
            elif len(right) > 1:
                halves, limit = self.split(right), ranks[right] + 0.5  # of equal joins the one across is further left
                right = halves[0] if halves else right
            else:
                return True
            if halves is None:
                return False


class Automaton:
    """States and arcs, numbered as they are met. ``arcs[state][character]`` is (next state,
    change of the number of tokens); ``states[state]`` is what the state stands for: the open
    suffix, and for each place in it, from its end to its start, the last piece and the tokens since."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.reset()

    def reset(self) -> None:
        self.states: list[tuple] = []
        self.arcs: list[dict[str, tuple[int, int]]] = []
        self.numbers: dict[tuple, int] = {}
        self.readings: dict[str, tuple] = {}
        self.number(("", ((None, 0),)))  # at the start there is no last piece

    def number(self, state: tuple) -> int:
        if (n := self.numbers.get(state)) is None:
            n = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.arcs.append({})
        return n

    def reading(self, read: str) -> tuple:
        """Of an open suffix with its next character: the pieces that end there, longest first, as (characters
        before the last one, piece); the open suffix it leads to; and for each of its places whether a piece can begin there."""
        ranks, prefixes = self.pieces.ranks, self.pieces.prefixes
        ends = [(len(read) - i - 1, read[i:]) for i in range(len(read)) if read[i:] in ranks]
        node = next(read[i:] for i in range(len(read) + 1) if read[i:] in prefixes)
        found = self.readings[read] = (ends, node, [node[len(node) - i :] in prefixes for i in range(1, len(node) + 1)])
        return found

    def step(self, state: int, character: str) -> tuple[int, int]:
        """The arc of ``character`` from a state, compiled."""
        suffix, places = self.states[state]
        read = suffix + character
        ends, node, begins = self.readings.get(read) or self.reading(read)
        if character in self.pieces.ranks:
            valid, cost = self.pieces.valid, 1
            for back, piece in ends:
                if (before := places[back]) is not None and (before[0] is None or valid(before[0], piece)):
                    break
        else:
            piece, back, cost = character, 0, len(character.encode("utf-8", "surrogatepass"))
        change = cost - places[back][1]
        moved = [(piece, 0)]
        for place, begin in zip(places, begins):
            moved.append((place[0], place[1] + change) if begin and place is not None else None)
        arc = self.arcs[state][character] = (self.number((node, tuple(moved))), change)
        return arc

    def count(self, text: str) -> int:
        """The tokens of a text: the annotations along its path."""
        if len(self.states) > MOST_STATES:
            self.reset()
        state, total, arcs = 0, 0, self.arcs
        for character in text:
            arc = arcs[state].get(character) or self.step(state, character)
            state = arc[0]
            total += arc[1]
        return total


class Segments(dict):
    """segment (with its front spaces) -> number of tokens."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, segment: str) -> int:
        n = self.automaton.count(segment.replace(" ", MARK))
        if len(segment) <= KEPT_CHARS:
            if len(self) >= MOST_SEGMENTS:
                self.clear()
            self[segment] = n
        return n


class Transducer:
    def __init__(self, path: str):
        import sentencepiece

        p = self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(p.vocab_size())
        pieces = {p.id_to_piece(i): p.get_score(i) for i in ids if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))}
        self.arcs = Segments(Automaton(Pieces(pieces)))
        # The model is compiled if it is one of this kind: spaces kept, one put in front, unknown characters in bytes.
        plain = not any(re.search(f"[^{MARK}]{MARK}", x) for x in pieces) and sum(map(p.is_byte, ids)) == 256
        probes = ["a  b ", " a  b ", "ab\tc", "日本\u0001é", "the cat sat", "ﬁ Å"]
        self.compiled = plain and all(sum(map(self.arcs.__getitem__, SEGMENT.findall(" " + x))) == len(p.encode(x)) for x in probes)

    def chunk_map(self, chunk: str) -> tuple[str, int | None, str]:
        """(head, tokens between the first and the last cut, tail); the number is
        None, and the tail empty, if the chunk has no cut."""
        parts = SEGMENT.findall(chunk)
        if len(parts) < 2:
            return chunk, None, ""
        return parts[0], sum(map(self.arcs.__getitem__, parts[1:-1])), parts[-1]

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The map of two neighbouring chunks from the maps of each."""
        last, first = (a[0] if a[1] is None else a[2]), b[0]
        if not last or not first:
            joined, cut = last + first, False
        else:
            cut = not last.endswith(" ") and first.startswith(" ")
            joined = last + first
        if a[1] is None and b[1] is None:
            return (last, 0, first) if cut else (joined, None, "")
        if a[1] is None:
            return (last, self.arcs[first] + b[1], b[2]) if cut else (joined, b[1], b[2])
        if b[1] is None:
            return (a[0], a[1] + self.arcs[last], first) if cut else (a[0], a[1], joined)
        middle = self.arcs[last] + self.arcs[first] if cut else self.arcs[joined] if joined else 0
        return a[0], a[1] + middle + b[1], b[2]

    def scan(self, maps: list[tuple]) -> list[tuple]:
        """Inclusive prefix scan: pair up, scan the halves, fill in between."""
        if len(maps) < 2:
            return maps
        pairs = self.scan([self.compose(maps[i], maps[i + 1]) for i in range(0, len(maps) - 1, 2)])
        return [maps[0] if i == 0 else pairs[i // 2] if i % 2 else self.compose(pairs[i // 2 - 1], maps[i]) for i in range(len(maps))]

    def count(self, text: str, chunk: int = CHUNK) -> int:
        if not self.compiled:
            return len(self.processor.encode(text))
        if not text:
            return 0
        text = " " + text.replace(MARK, " ")  # the library's own front space
        if len(text) <= chunk:
            return sum(map(self.arcs.__getitem__, SEGMENT.findall(text)))
        maps = [self.chunk_map(text[i : i + chunk]) for i in range(0, len(text), chunk)]
        head, between, tail = self.scan(maps)[-1]
        return self.arcs[head] + (0 if between is None else between + self.arcs[tail])


@lru_cache(maxsize=2)
def load(path: str) -> Transducer:
    return Transducer(path)


def count_tokens(docs: DataFrame, model: str, limit: int, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``.

    ``model`` is the path of a SentencePiece model on the workers, ``limit`` the
    number of tokens above which ``over_limit`` is true. A null text counts as
    the empty one (no bytes, no tokens), a null doc_id stays null, a repeated
    row is counted again, a text of any length is read whole, chunk by chunk, an empty table gives an empty table, and columns
    other than doc_id and text are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = load(model)
        gc.disable()  # states and arcs hold no cycles, and looking for some would pass over all of them again and again
        try:
            for batch in batches:
                texts = batch.column(1).to_pylist()
                n = [transducer.count(t, chunk) for t in texts]
                n_bytes = [len(t) if t.isascii() else len(t.encode()) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"])
        finally:
            gc.enable()

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
