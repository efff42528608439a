"""Words of many texts as spans of one byte buffer, without a Python object for each word.

A buffer is the joined texts of a slice of rows, ended by PAD separators, so that
eight bytes can be read from the start of any word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PAD = 8
#: Bytes of text taken as one slice; a single longer text is a slice of its own.
SLICE_BYTES = 16 << 20
#: By the number of bytes that belong to a word (0 to 8): which of eight big-endian bytes those are.
BIG_ENDIAN = np.array([0] + [(1 << 64) - (1 << 8 * (8 - n)) for n in range(1, 9)], np.uint64)
LITTLE_ENDIAN = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def row_slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have at most ``most`` bytes together, at least one row each."""
    first, held = 0, 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        if held and held + n > most:
            yield first, i
            first, held = i, 0
        held += n + 1
    if first < len(texts):
        yield first, len(texts)


def joined(texts: pa.Array, table: np.ndarray, separator: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """(buffer, first byte of each text): the texts (binary) with ``separator`` before each and
    PAD of them behind the last, every byte replaced by ``table``."""
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts), separator)[0].as_buffer()
    buffer = np.frombuffer((separator + whole.to_pybytes() + separator * PAD).translate(table.tobytes()), np.uint8)
    return buffer, np.cumsum(lengths + 1) - lengths


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, lengths) of the runs of True; the first and last element are False."""
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    return edges[0::2].astype(np.int32), (edges[1::2] - edges[0::2]).astype(np.int32)


def chunk(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: int, order: str = ">u8") -> np.ndarray:
    """The bytes ``depth`` to ``depth`` + 8 of each word as a number, zero beyond its end."""
    eight = np.ndarray((len(buffer) - 7,), order, buffer, 0, (1,))
    own = np.clip(lengths - depth, 0, 8)
    at = np.minimum(starts + depth, len(eight) - 1) if depth else starts
    return eight[at].astype(np.uint64) & (BIG_ENDIAN if order == ">u8" else LITTLE_ENDIAN)[own]


def gather(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of the spans one behind the other, copied without a loop."""
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return offsets, buffer[np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1], dtype=np.int32)]


def strings(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray, joined: int = 1) -> pa.StringArray:
    """The spans as an Arrow array, each ``joined`` of them in a row as one string."""
    offsets, data = gather(buffer, starts, lengths)
    offsets = np.ascontiguousarray(offsets[::joined])
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data))


def mix(x: np.ndarray, factor: int) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(factor)
    return x ^ (x >> np.uint64(29))


def hashes(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray, factor: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A 64-bit hash of each word; two factors give independent ones."""
    found = mix(chunk(buffer, starts, lengths, 0, "<u8") ^ lengths.astype(np.uint64), factor)
    depth, open_ = 8, np.flatnonzero(lengths > 8)
    while len(open_):
        found[open_] = mix(found[open_] ^ chunk(buffer, starts[open_], lengths[open_], depth, "<u8"), factor)
        depth += 8
        open_ = open_[lengths[open_] > depth]
    return found


#: Pointers that a sort splits no further by a pivot.
SMALL = 1 << 15


def _sort_small(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray, pointers: np.ndarray, key: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The end of the recursion: all runs of equal bytes are taken eight bytes deeper together."""
    order = np.argsort(key, kind="stable")
    pointers, key = pointers[order], key[order]
    new = np.ones(len(pointers), bool)
    new[1:] = key[1:] != key[:-1]
    places, run = np.arange(len(pointers)), np.cumsum(new) - 1
    while True:
        deeper = np.zeros(run[-1] + 1, bool)
        deeper[run[lengths[pointers[places]] > depth + 8]] = True
        again = deeper[run]
        places, run = places[again], run[again]
        if not len(places):
            return pointers, new
        depth += 8
        own = pointers[places]
        key = chunk(buffer, starts[own], lengths[own], depth)
        order = np.lexsort((key, run))
        pointers[places], key = own[order], key[order]
        changed = np.ones(len(places), bool)
        changed[1:] = (run[1:] != run[:-1]) | (key[1:] != key[:-1])
        new[places] |= changed
        run = np.cumsum(changed) - 1


def sort_pointers(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of word pointers: (order, whether each begins a run of equal words).

    The words are split three ways by their next eight bytes against a pivot; the middle
    part, equal so far, goes on eight bytes deeper. No word holds a zero byte, so one that
    ends sorts before those it begins. The order is stable."""
    done: list[tuple[np.ndarray, np.ndarray]] = []
    todo = [(np.arange(len(starts), dtype=np.int32), chunk(buffer, starts, lengths, 0), 0)]
    while todo:
        pointers, key, depth = todo.pop()
        if key is None:  # whole words, all equal
            done.append((pointers, np.arange(len(pointers)) == 0))
        elif len(pointers) <= SMALL:
            if len(pointers):
                done.append(_sort_small(buffer, starts, lengths, pointers, key, depth))
        else:
            sample = np.sort(key[:: max(1, len(key) // 101)])
            pivot = sample[len(sample) // 2]
            less, equal = key < pivot, key == pivot
            more, same = ~(less | equal), pointers[equal]
            todo.append((pointers[more], key[more], depth))
            ended = lengths[same].max() <= depth + 8
            todo.append((same, None if ended else chunk(buffer, starts[same], lengths[same], depth + 8), depth + 8))
            todo.append((pointers[less], key[less], depth))
    if not done:
        return np.zeros(0, np.int32), np.zeros(0, bool)
    return np.concatenate([p for p, _ in done]), np.concatenate([n for _, n in done])
