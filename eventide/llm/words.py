"""Words of whole texts as numpy arrays, one Arrow column at a time.

A word is a maximal run of bytes other than the six ASCII white-space bytes, so
``[^\\x20\\x09-\\x0D]+`` over the characters. Everything here works on the flat
UTF-8 buffer of a string column; no Python object is made per word.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Text bytes handled at once; bounds the temporary arrays of a task.
SLICE_BYTES = 1 << 22
# Longer words are hashed one by one.
LANES = 8

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

# Bytes between runs of letters, and between runs of letters and digits; beyond ASCII all count as letters.
NO_LETTER = np.ones(256, dtype=bool)
NO_LETTER[0x80:] = False
for _first, _last in (b"AZ", b"az"):
    NO_LETTER[_first : _last + 1] = False
NO_ALNUM = NO_LETTER.copy()
NO_ALNUM[ord("0") : ord("9") + 1] = False

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_MASK = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], dtype=np.uint64)
_MUL = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of some texts: byte bounds in ``data``, and where each text begins and ends among them."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # per text, plus one closing entry

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def word(self, k: int) -> bytes:
        return self.data[self.start[k] : self.end[k]].tobytes()


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``limit`` bytes; a longer text stands alone."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), len(texts))
        yield at, to
        at = to


def split(texts: pa.Array, space: np.ndarray = SPACE) -> Words:
    """All words of all texts."""
    data, offsets = buffers(texts)
    return split_bytes(data, offsets, space)


def folded(texts: pa.Array, breaks: np.ndarray) -> Words:
    """Words in lower case (ASCII and Latin-1) between the bytes of ``breaks``."""
    data, offsets = buffers(texts)
    data = _LOWER[data]
    upper = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    data[1:][upper] += 32
    return split_bytes(data, offsets, breaks)


def ascii_folded(texts: pa.Array, breaks: np.ndarray) -> Words:
    """Words with A-Z in lower case between the bytes of ``breaks``."""
    data, offsets = buffers(texts)
    return split_bytes(_LOWER[data], offsets, breaks)


def split_bytes(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> Words:
    inside = np.zeros(len(data) + 1, dtype=bool)
    np.logical_not(space[data], out=inside[:-1])
    begins = inside[:-1].copy()
    begins[1:] &= ~inside[:-2]
    # A text ends its last word, whatever the next text begins with.
    cut = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begins[cut] |= inside[cut]
    ends = inside[:-1] & ~inside[1:]
    ends[cut - 1] |= inside[cut - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def hashes(words: Words, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    size = words.end - words.start
    out = mix(size.astype(np.uint64) * _MUL + np.uint64(seed))
    padded = np.concatenate([words.data, np.zeros(8, np.uint8)])
    lanes = np.lib.stride_tricks.sliding_window_view(padded, 8)
    live = np.flatnonzero(size <= 8 * LANES)
    for lane in range(LANES):
        if lane:
            live = live[size[live] > 8 * lane]
        if not len(live):
            break
        part = lanes[words.start[live] + 8 * lane].reshape(-1).view("<u8")
        part = part & _MASK[np.minimum(size[live] - 8 * lane, 8)]
        out[live] = mix((out[live] ^ part) * _MUL)
    for k in np.flatnonzero(size > 8 * LANES):
        out[k] = xxhash.xxh64_intdigest(words.word(k), seed)
    return out


def windows(values: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive values inside one text, and the index each starts at."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out *= np.uint64(0x100000001B3)
        out += values[k : k + n]
    room = np.repeat(first[1:], np.diff(first))[:n] - np.arange(n)
    at = np.flatnonzero(room >= width)
    return mix(out[at]), at


def text_of_words(words: Words, first: int, last: int) -> str:
    """Words ``first`` to ``last`` (inclusive), joined by one space."""
    return b" ".join(words.word(k) for k in range(first, last + 1)).decode("utf-8", "replace")
