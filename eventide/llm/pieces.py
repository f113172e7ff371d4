"""Coding texts by pieces: where no tokenizer rule reaches over a gap, each different piece is coded once.

A piece begins at a text's start, or at white space behind a character that is none. A
byte-level tokenizer splits words there before anything is merged, and no entry of a
piece tokenizer has a space behind another character, so the ids of a text are those
of its pieces.
"""

from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

from eventide.llm import words
from eventide.llm.token_files import CACHE_PIECES, _Codes

# Codes a list of pieces: all ids, and how many each piece has.
Batch = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]

# Pieces handed to a tokenizer in one call; what it returns for a piece is many times its ids.
CALL_PIECES = 8192

# Last bytes of white space beyond ASCII, and control characters that may count as such.
_MAY_END_SPACE = np.zeros(256, dtype=bool)
_MAY_END_SPACE[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF, *range(0x1C, 0x20)]] = True
# What begins Latin letters, whose last bytes are among them.
_LATIN = 0xC3


def cut(data: np.ndarray, offsets: np.ndarray, space_only: bool = False) -> words.Words:
    """Pieces of texts; with ``space_only`` they begin at the space character alone."""
    solid = ~words.SPACE[data] & ~_MAY_END_SPACE[data]
    solid[1:] |= _MAY_END_SPACE[data[1:]] & (data[:-1] == _LATIN)
    begins = (data == 0x20) if space_only else words.SPACE[data]
    begins[1:] &= solid[:-1]
    starts = offsets[:-1][np.diff(offsets) > 0]
    begins[:1] = False
    begins[starts] = True
    start = np.flatnonzero(begins)
    end = np.append(start[1:], len(data))[: len(start)]
    return words.Words(data, start, end, np.searchsorted(start, offsets))


def prefixed(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space before each."""
    return np.insert(data, offsets[:-1], 0x20), offsets + np.arange(len(offsets))


@dataclass
class Distinct:
    """The different pieces of some texts by two hashes, where each stands first, and which one every piece is."""

    key: np.ndarray
    check: np.ndarray
    start: np.ndarray
    end: np.ndarray
    which: np.ndarray


def distinct(found: words.Words) -> Distinct:
    key, first, which = np.unique(words.hashes(found), return_index=True, return_inverse=True)
    start, end = found.start[first], found.end[first]
    check = words.hashes(words.Words(found.data, start, end, np.array([0, len(first)])), seed=2)
    return Distinct(key, check, start, end, which)


class Coder:
    """A tokenizer of this worker with the pieces it has coded so far.

    Beyond ``most`` pieces those stay that were asked for again since they were coded,
    or none if these are too many. The pieces of one call come on top.
    """

    def __init__(self, batch: Batch, most: int) -> None:
        self.batch, self.most = batch, most
        self.codes = _Codes()
        # By place in the codes: whether the piece that begins there was asked for again.
        self.again = np.zeros(0, dtype=bool)

    def _thin(self) -> None:
        codes = self.codes
        key, check, begin, size = (np.concatenate(c) for c in zip(*codes.runs, strict=True))
        stay = self.again[begin]
        if 2 * int(stay.sum()) > self.most:
            stay[:] = False
        key, check, begin, size = key[stay], check[stay], begin[stay], size[stay]
        n = size.astype(np.int64)
        ids = codes.flat[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        codes.clear()
        codes.add(key, check, ids, n)
        self.again = np.zeros(0, dtype=bool)

    def encode(self, found: words.Words, pieces: Distinct | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's ids begin, with a closing entry."""
        codes = self.codes
        pieces = pieces or distinct(found)
        if len(codes) > self.most:
            self._thin()
        begin, size = codes.find(pieces.key, pieces.check)
        if len(self.again) < len(codes.flat):
            self.again = np.concatenate([self.again, np.zeros(len(codes.flat) - len(self.again), dtype=bool)])
        self.again[begin[size > 0]] = True
        new = np.flatnonzero(size == 0)
        if len(new):
            raw = found.data.tobytes()
            ids, n = [], []
            for at in range(0, len(new), CALL_PIECES):
                some = new[at : at + CALL_PIECES]
                bounds = zip(pieces.start[some].tolist(), pieces.end[some].tolist(), strict=True)
                coded = self.batch([raw[a:b] for a, b in bounds])
                ids.append(coded[0])
                n.append(coded[1])
            n = np.concatenate(n)
            begin[new] = codes.used + np.cumsum(n) - n
            size[new] = n
            codes.add(pieces.key[new], pieces.check[new], np.concatenate(ids), n)
        n = size[pieces.which]
        before = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        source = np.repeat(begin[pieces.which] - before[:-1], n) + np.arange(before[-1])
        return codes.flat[source], before[found.first]


def _joined(coded: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(c) for c in coded], dtype=np.int64)
    return np.array([i for c in coded for i in c], dtype=np.uint32), size


@cache
def byte_coder(path: str, plain_specials: bool, most: int = CACHE_PIECES) -> Coder:
    """A byte-level tokenizer; ``plain_specials`` takes special tokens in a text as plain text."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = plain_specials

    def batch(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        coded = tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        return _joined([c.ids for c in coded])

    return Coder(batch, most)


@cache
def piece_coder(path: str, most: int = CACHE_PIECES) -> Coder:
    """A piece tokenizer over pieces that begin with a space, which it adds itself."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    gap = processor.piece_to_id("▁")

    def batch(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        coded = processor.encode([p[1:].decode() for p in pieces], num_threads=1)
        return _joined([c or [gap] for c in coded])

    return Coder(batch, most)


def _byte_letters() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: printable bytes stand
    for themselves, the others take the letters from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(others)}


@cache
def byte_tokens(path: str) -> pa.Array:
    """The bytes of every token of a byte-level vocabulary, by id."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    letters = _byte_letters()
    out = [b""] * tokenizer.get_vocab_size()
    for token, number in tokenizer.get_vocab().items():
        out[number] = bytes(letters[c] for c in token)
    return pa.array(out, pa.large_binary())


@cache
def piece_tokens(path: str) -> pa.Array:
    """The bytes of every token of a piece vocabulary, by id."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for number in range(processor.get_piece_size()):
        piece = processor.id_to_piece(number)
        if processor.is_byte(number):
            out.append(bytes([int(piece[3:-1], 16)]))
        else:
            out.append(piece.replace("▁", " ").encode())
    return pa.array(out, pa.large_binary())
