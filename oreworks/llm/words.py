"""Words of many texts at once, as 64-bit hashes, with numpy.

Two different words share a hash with a probability of about 2**-64. The counts and sets
built on these hashes accept that.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed in one step; a text above it is cut between words. A step takes
#: some 60 times as much in a worker, and there is one worker for each core of an executor.
STEP = 1 << 18


def byte_class(separators: bytes) -> np.ndarray:
    """Per byte: is it part of a word?"""
    inside = np.ones(256, dtype=bool)
    inside[list(separators)] = False
    return inside


#: Words are runs of anything but space and the control characters 9 to 13.
BLANK_SEPARATED = byte_class(bytes([0x20, *range(0x09, 0x0E)]))
#: Words are runs of ASCII letters and digits and of everything beyond ASCII.
ALPHANUMERIC = byte_class(
    bytes(b for b in range(128) if not (chr(b).isalnum() and chr(b).isascii()))
)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.uint64, np.uint64]:
    """A number for each byte (upper-case ASCII as lower-case) and a base with its inverse."""
    rng = np.random.Generator(np.random.PCG64(20240229))
    numbers = rng.integers(1, 1 << 63, size=256, dtype=np.uint64)
    numbers[65:91] = numbers[97:123]
    base = int(rng.integers(1 << 61, 1 << 62)) * 2 + 1
    return numbers, None, np.uint64(base), np.uint64(pow(base, -1, 1 << 64))


@cache
def _powers(size: int, inverse: bool) -> np.ndarray:
    _, _, base, back = _tables()
    powers = np.full(size, back if inverse else base, dtype=np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of each number over all of its bits; one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def spans(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end position of every word."""
    flags = np.zeros(len(data) + 2, dtype=np.int8)
    flags[1:-1] = inside[data]
    edges = np.diff(flags)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _hash_piece(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, ...]:
    starts, ends = spans(data, inside)
    size = 1 << max(STEP.bit_length(), int(len(data)).bit_length())
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_tables()[0][data] * _powers(size, False)[: len(data)], out=sums[1:])
    lengths = (ends - starts).astype(np.uint64)
    return starts, ends, mix((sums[ends] - sums[starts]) * _powers(size, True)[starts] + lengths)


def hash_words(
    data: np.ndarray, inside: np.ndarray = BLANK_SEPARATED
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and past-the-end byte, and hash, of every word; ASCII letters in any case agree."""
    if len(data) <= STEP:
        return _hash_piece(data, inside)
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + STEP)
        if end < len(data):
            gaps = np.flatnonzero(~inside[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:  # a word longer than a step
                rest = np.flatnonzero(~inside[data[end:]])
                end = end + int(rest[0]) + 1 if len(rest) else len(data)
        first, last, hashes = _hash_piece(data[at:end], inside)
        parts.append((first + at, last + at, hashes))
        at = end
    return tuple(np.concatenate(x) for x in zip(*parts))


def shingle_hashes(hashes: np.ndarray, words: int) -> np.ndarray:
    """A hash for each run of so many words; for fewer words, one for the whole sequence."""
    if len(hashes) == 0:
        return hashes
    width = min(words, len(hashes))
    count = len(hashes) - width + 1
    out = np.full(count, width, dtype=np.uint64)
    for k in range(width):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + count])
    return out


def text_bytes(column: pa.Array | pa.ChunkedArray) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each text without copies; null: empty."""
    if isinstance(column, pa.ChunkedArray):
        for chunk in column.chunks:
            yield from text_bytes(chunk)
        return
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    for k, null in enumerate(column.is_null().to_pylist()):
        yield raw[:0] if null else raw[bounds[k] : bounds[k + 1]]


def batched(
    texts: Iterator[np.ndarray], limit: int = STEP
) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Several texts as one array, a blank after each: their numbers, bounds and bytes."""
    numbers: list[int] = []
    parts: list[np.ndarray] = []
    size = 0
    blank = np.array([0x20], dtype=np.uint8)

    def made() -> tuple[list[int], np.ndarray, np.ndarray]:
        ends = np.cumsum([len(p) + 1 for p in parts[::2]])
        return numbers, ends, np.concatenate(parts)

    for k, text in enumerate(texts):
        if numbers and size + len(text) > limit:
            yield made()
            numbers, parts, size = [], [], 0
        numbers.append(k)
        parts += [text, blank]
        size += len(text) + 1
    if numbers:
        yield made()


def hashed_batches(
    column: pa.Array | pa.ChunkedArray, inside: np.ndarray = BLANK_SEPARATED
) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Several texts at once: their numbers, where each one's words end, and all word hashes."""
    for numbers, ends, data in batched(text_bytes(column)):
        starts, _, hashes = hash_words(data, inside)
        yield numbers, np.searchsorted(starts, ends), hashes


def hashed_texts(
    column: pa.Array | pa.ChunkedArray, inside: np.ndarray = BLANK_SEPARATED
) -> Iterator[tuple[int, np.ndarray]]:
    """Number and word hashes of each text, in order."""
    for numbers, cuts, hashes in hashed_batches(column, inside):
        at = 0
        for number, cut in zip(numbers, cuts):
            yield number, hashes[at:cut]
            at = cut
