"""Token ids of whole texts, by a vocabulary file of the tokenizers library.

A BPE tokenizer first cuts a text into words by a pattern and encodes every
word by itself, so the ids of a text are the joined ids of its words, and each
distinct word needs encoding only once per worker. New words are merged by
tiktoken's piece encoder, loaded with the merges of the same file.

That is done for texts made of characters on which Python's ``re`` and the
library cannot disagree (tab, line feed, printable ASCII, Latin letters and
signs up to U+024F) and that hold no special-token opening ``<|``. All other
texts, and files of another shape, go through the library whole. Either way
the ids are the library's; the tests compare both.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np

PLAIN = re.compile("[\\t\\n\\x20-\\x7e\\xa1-\\u024f]*")
#: Words of at most so many characters kept per worker, and how many; the table is emptied when it is full, which costs time only.
KEPT_CHARS, MOST_WORDS = 48, 300_000
WORD_END = "</w>"
#: Stands for the end of a word in the piece encoder; no UTF-8 text holds this byte.
END_BYTE = b"\xff"

# The word patterns that the two kinds of vocabulary file state.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def char_class(major: str) -> str:
    """The characters of a Unicode category below U+0250, as the inside of a class."""
    return "".join(re.escape(chr(c)) for c in range(0x21, 0x250) if unicodedata.category(chr(c))[0] == major)


def plain_pattern(pattern: str) -> re.Pattern:
    """``pattern`` for texts that are PLAIN, on the standard library's engine."""
    for name in "LN":
        pattern = pattern.replace(rf"[\p{{{name}}}]", rf"\p{{{name}}}")
    inside = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{char_class('L')}{char_class('N')}]")
    return re.compile(inside.replace(r"\p{L}", f"[{char_class('L')}]").replace(r"\p{N}", f"[{char_class('N')}]"))


def byte_letters() -> dict[str, int]:
    """The printable letter that a byte-level vocabulary writes for each byte."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordIds(dict):
    """word -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, model: dict):
        import tiktoken

        super().__init__()
        letters, vocab, ended = byte_letters(), model["vocab"], bool(model.get("end_of_word_suffix"))

        def raw(token: str) -> bytes:
            stem = token.removesuffix(WORD_END) if ended else token
            return bytes(letters[c] for c in stem) + (END_BYTE if stem != token else b"")

        singles = [c for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        order = [*singles, *([c + WORD_END for c in singles] if ended else []), *("".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"])]
        ranks = {raw(t): r for r, t in enumerate(order)}
        ids = [vocab[t] for t in order]
        if ended:  # the mark alone is never left over, since it merges with the byte before it first
            ranks[END_BYTE] = len(ids)
            ids.append(0)
        self.of_rank = [i.to_bytes(4, "little") for i in ids]
        self.pieces = tiktoken.Encoding("words", pat_str="x", mergeable_ranks=ranks, special_tokens={}, explicit_n_vocab=None)._core_bpe.encode_single_piece
        self.end = END_BYTE if ended else b""

    def __missing__(self, word: str) -> bytes:
        of_rank = self.of_rank
        ids = b"".join([of_rank[r] for r in self.pieces(word.encode() + self.end)])
        if len(word) <= KEPT_CHARS:
            if len(self) >= MOST_WORDS:
                self.clear()
            self[word] = ids
        return ids


class FastTokenizer:
    """``ids(text)``: the bytes of the little-endian unsigned 32-bit ids of ``text``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.n_vocab = self.library.get_vocab_size(with_added_tokens=True)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.words, self.pattern, self.lower = None, None, False
        cutter, model = spec["pre_tokenizer"], spec["model"]
        plain_bpe = model["type"] == "BPE" and not (model.get("dropout") or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("ignore_merges"))
        if plain_bpe and cutter["type"] == "ByteLevel" and cutter["use_regex"] and not cutter["add_prefix_space"] and spec["normalizer"] is None and not model.get("end_of_word_suffix"):
            self.pattern = plain_pattern(BYTE_PATTERN)
        elif plain_bpe and cutter["type"] == "Sequence" and cutter["pretokenizers"][0].get("pattern") == {"Regex": WORD_PATTERN} and model.get("end_of_word_suffix") == WORD_END:
            self.pattern, self.lower = plain_pattern(WORD_PATTERN), True
        if self.pattern is not None:
            self.words = WordIds(model)

    def by_library(self, text: str) -> bytes:
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if self.words is None or "<|" in text or not PLAIN.fullmatch(text):
            return self.by_library(text)
        return b"".join(map(self.words.__getitem__, self.pattern.findall(text.lower() if self.lower else text)))


@lru_cache(maxsize=4)
def load(path: str) -> FastTokenizer:
    """One tokenizer per worker process and file."""
    return FastTokenizer(path)
