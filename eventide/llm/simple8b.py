"""Simple-8b coding of whole numbers in 64-bit words.

The lowest four bits of a word select how many ids it holds and how wide they
are; the other 60 bits hold them. An id of more than 60 bits is an escape: its
word holds an index into a list of raw ids. Ids are cut into frames that begin
at a word of their own and whose offsets are kept, so that all frames are packed
side by side and all words of one selector are unpacked at once.
"""

import struct

import numpy as np

FRAME = 1024
ESCAPE = 0
# Ids per word and their bits, by selector; selector 0 is the escape.
LAYOUT = [(1, 60), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
COUNT = np.array([c for c, _ in LAYOUT], dtype=np.int64)
BITS = np.array([b for _, b in LAYOUT], dtype=np.uint64)
_HEADER = struct.Struct("<QQQ")
_FOUR = np.uint64(4)


# Bits of each number below 2 ** 16.
_WIDTH = np.zeros(1 << 16, dtype=np.uint8)
for _bit in range(16):
    _WIDTH[1 << _bit :] = _bit + 1


def widths(ids: np.ndarray) -> np.ndarray:
    """Bits that each id takes."""
    out = np.zeros(len(ids), dtype=np.uint8)
    for limb in range(4):
        part = (ids >> np.uint64(16 * limb)) & np.uint64(0xFFFF)
        out = np.where(part != 0, _WIDTH[part.astype(np.int64)] + np.uint8(16 * limb), out)
        if int(ids.max(initial=0)) >> (16 * limb + 16) == 0:
            break
    return out


def _selectors(ids: np.ndarray) -> np.ndarray:
    """For each position the selector that packs most ids from there on.

    Frames are rows; the zeros behind a frame's last id may fill up a word. The
    widest of the next c ids comes from that of the next 1, 2, 4, ... ids.
    """
    frames, ahead = -(-len(ids) // FRAME), 64
    width = np.zeros((frames, FRAME + ahead), dtype=np.uint8)
    flat = np.zeros(frames * FRAME, dtype=np.uint8)
    flat[: len(ids)] = widths(ids)
    width[:, :FRAME] = flat.reshape(frames, FRAME)
    widest = {1: width}
    for c in (2, 4, 8, 16, 32):
        half = widest[c // 2]
        widest[c] = np.maximum(half[:, : half.shape[1] - c // 2], half[:, c // 2 :])
    best = np.full((frames, FRAME), ESCAPE, dtype=np.uint8)
    for selector in range(len(LAYOUT) - 1, 0, -1):
        count, bits = LAYOUT[selector]
        c = 1 << (count.bit_length() - 1)
        most = widest[c][:, :FRAME]
        if count > c:
            most = np.maximum(most, widest[c][:, count - c : count - c + FRAME])
        best[most <= bits] = selector
    return best.reshape(-1)[: len(ids)]


def pack(ids: np.ndarray) -> bytes:
    """Frames of ``ids`` with their offsets, as one block."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    starts = np.arange(0, n, FRAME)
    stops = np.minimum(starts + FRAME, n)
    best = _selectors(ids)
    step = COUNT[best]
    # All frames advance together, one word at a time.
    at, frame, heads, owners = starts.copy(), np.arange(len(starts)), [], []
    while len(at):
        heads.append(at)
        owners.append(frame)
        at = at + step[at]
        live = at < stops[frame]
        at, frame = at[live], frame[live]
    head = np.sort(np.concatenate(heads)) if heads else np.zeros(0, np.int64)
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(starts)))]).astype("<u4")
    selector = best[head]
    out = selector.astype(np.uint64)
    padded = np.concatenate([ids, np.zeros(64, np.uint64)])
    last = np.concatenate([stops[np.searchsorted(starts, head, side="right") - 1]]) if n else head
    for s in np.unique(selector):
        if s == ESCAPE:
            continue
        rows = np.flatnonzero(selector == s)
        for k in range(COUNT[s]):
            place = head[rows] + k
            value = np.where(place < last[rows], padded[place], np.uint64(0))
            out[rows] |= value << (_FOUR + BITS[s] * np.uint64(k))
    escaped = np.flatnonzero(selector == ESCAPE)
    out[escaped] |= np.arange(len(escaped), dtype=np.uint64) << _FOUR
    raw = ids[head[escaped]]
    return b"".join(
        [
            _HEADER.pack(n, len(out), len(raw)),
            offsets.tobytes(),
            out.astype("<u8").tobytes(),
            raw.astype("<u8").tobytes(),
        ]
    )


def unpack(block: bytes) -> np.ndarray:
    """The ids of one block."""
    n, n_words, n_raw = _HEADER.unpack_from(block)
    frames = -(-n // FRAME)
    at = _HEADER.size
    offsets = np.frombuffer(block, "<u4", frames + 1, at).astype(np.int64)
    at += 4 * (frames + 1)
    packed = np.frombuffer(block, "<u8", n_words, at)
    raw = np.frombuffer(block, "<u8", n_raw, at + 8 * n_words)
    selector = (packed & np.uint64(15)).astype(np.int64)
    count = COUNT[selector]
    # A word's first id: words before it in its frame, on top of the frame's start.
    before = np.concatenate([[0], np.cumsum(count)])
    frame = np.repeat(np.arange(frames), np.diff(offsets))
    place = before[:-1] - before[offsets[frame]] + frame * FRAME
    out = np.zeros(n + 64, dtype=np.uint64)
    stop = np.minimum((frame + 1) * FRAME, n)
    for s in np.unique(selector):
        rows = np.flatnonzero(selector == s)
        if s == ESCAPE:
            out[place[rows]] = raw[(packed[rows] >> _FOUR).astype(np.int64)]
            continue
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for k in range(COUNT[s]):
            to = place[rows] + k
            inside = to < stop[rows]
            out[to[inside]] = (packed[rows[inside]] >> (_FOUR + BITS[s] * np.uint64(k))) & mask
    return out[:n]
