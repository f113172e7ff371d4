"""A linear-chain conditional random field over the words of texts, in numpy.

A word's score for a label is the sum of the weights of its features: its byte
n-grams with word bounds, its prefixes and suffixes, and the lexicons that list it.
Consecutive words are tied by learned transitions. Texts are cut into segments that
all run side by side; what passes between segments are the products of their
transfer matrices, so the marginals are those of the whole chain.
"""

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from eventide.llm import words as W

BUCKETS = 1 << 16
SEGMENT = 256
NGRAMS = (2, 3, 4)
AFFIXES = (3, 5)
# Words listed per label, if seen this often.
LEXICON, SEEN = 2000, 3
# Numbers in the largest array over the words of texts that are handled together, besides one text.
CELLS = 1 << 25


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # feature bucket x label
    transitions: np.ndarray  # label x label, log
    lexicons: list[np.ndarray]  # sorted word hashes per label
    spelled: np.ndarray  # a bit per three bytes: whether they were learned from


def _bounded(words: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words with their bounds as bytes, where each begins, and per byte its word and what is left of it."""
    n = len(words.start)
    size = words.end - words.start
    # ^word$ for all words, one after the other, with room to read past the end.
    bound = np.concatenate([[0], np.cumsum(size + 2)])
    flat = np.full(bound[-1] + 8, ord("$"), dtype=np.uint8)
    flat[bound[:-1]] = ord("^")
    source = np.arange(size.sum()) + np.repeat(words.start - (np.cumsum(size) - size), size)
    target = np.arange(size.sum()) + np.repeat(bound[:-1] + 1 - (np.cumsum(size) - size), size)
    flat[target] = words.data[source]
    owner = np.repeat(np.arange(n), size + 2)
    left = np.repeat(bound[1:], size + 2) - np.arange(bound[-1])
    return flat, bound, owner, left


def features(words: W.Words, lexicons: list[np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of each word, and the word each belongs to."""
    flat, bound, owner, left = _bounded(words)
    n, size = len(words.start), words.end - words.start
    found, of = [], []
    value = np.zeros(bound[-1], dtype=np.uint64)
    for k in range(max(NGRAMS)):
        value |= flat[k : k + bound[-1]].astype(np.uint64) << np.uint64(8 * k)
        if k + 1 in NGRAMS:
            whole = left > k
            found.append(_bucket(value[whole], k + 1))
            of.append(owner[whole])
    lanes = np.lib.stride_tricks.sliding_window_view(flat, 8)
    for k in AFFIXES:
        long = np.flatnonzero(size >= k)
        mask = np.uint64((1 << (8 * k)) - 1)
        for side, at in ((1, bound[long] + 1), (2, bound[long + 1] - 1 - k)):
            found.append(_bucket(lanes[at].reshape(-1).view("<u8") & mask, 16 * side + k))
            of.append(long)
    for label, lexicon in enumerate(lexicons):
        listed = np.flatnonzero(_contains(lexicon, keys))
        found.append(_bucket(np.full(len(listed), label, dtype=np.uint64), 64))
        of.append(listed)
    return np.concatenate(found), np.concatenate(of)


def _bucket(value: np.ndarray, kind: int) -> np.ndarray:
    return (W.mix(value + (np.uint64(kind) << np.uint64(48))) & np.uint64(BUCKETS - 1)).astype(np.int32)


def _trigrams(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """All runs of three bytes of words with their bounds, as numbers, and the word of each."""
    flat, bound, owner, left = _bounded(words)
    value = np.zeros(bound[-1], dtype=np.int64)
    for k in range(3):
        value |= flat[k : k + bound[-1]].astype(np.int64) << (8 * k)
    whole = left >= 3
    return value[whole], owner[whole]


def known(model: Model, texts) -> np.ndarray:
    """Per text the share of its words of which at least half the trigrams were learned from; 0 without words."""
    words = W.folded(texts, W.NO_LETTER)
    if not len(words.start):
        return np.zeros(len(words.first) - 1)
    some, keys, which = distinct(words)
    value, owner = _trigrams(some)
    seen = model.spelled[value >> 3] >> (value & 7).astype(np.uint8) & 1
    holds = 2 * np.bincount(owner, seen, len(keys)) >= np.bincount(owner, minlength=len(keys))
    return np.bincount(words.text_of, holds[which], len(words.first) - 1) / np.maximum(words.counts, 1)


def _contains(ordered: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(ordered, keys), len(ordered) - 1)
    return ordered[at] == keys


def distinct(words: W.Words) -> tuple[W.Words, np.ndarray, np.ndarray]:
    """The different words, their hashes, and which of them each word is."""
    keys, first, which = np.unique(W.hashes(words), return_index=True, return_inverse=True)
    some = W.Words(words.data, words.start[first], words.end[first], np.array([0, len(first)]))
    return some, keys, which


def emissions(found: np.ndarray, of: np.ndarray, n: int, weights: np.ndarray) -> np.ndarray:
    """Scores of ``n`` words for each label, as factors of at most 1."""
    score = np.stack([np.bincount(of, weights[found, k], n) for k in range(weights.shape[1])], axis=1)
    return np.exp(score - score.max(axis=1, keepdims=True, initial=-np.inf)).astype(np.float32)


def _norm(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=tuple(range(1, x.ndim)), keepdims=True)


class Chain:
    """Segments of the texts whose words ``first`` delimits."""

    def __init__(self, first: np.ndarray):
        count = np.diff(first)
        per_text = -(-count // SEGMENT)
        self.text = np.repeat(np.arange(len(count)), per_text)
        self.head = np.concatenate([[0], np.cumsum(per_text)])
        self.nth = np.arange(len(self.text)) - self.head[self.text]
        self.start = first[self.text] + self.nth * SEGMENT
        self.size = np.minimum(count[self.text] - self.nth * SEGMENT, SEGMENT)
        # Longer segments first: those with a t-th word are a prefix.
        self.order = np.argsort(-self.size, kind="stable")
        self.steps = int(self.size.max(initial=0))
        self.live = np.searchsorted(-self.size[self.order], -np.arange(self.steps), side="left")

    def marginals(self, e: np.ndarray, a: np.ndarray, pairs: np.ndarray | None = None) -> np.ndarray:
        """Marginal of each word over the labels; adds expected label pairs to ``pairs``."""
        n, k = len(self.text), len(a)
        start = self.start[self.order]
        # Transfer matrix of each segment; with one segment per text none is needed.
        entry, leave = np.full((n, k), 1.0 / k, np.float32), np.ones((n, k), np.float32)
        if int(self.nth.max(initial=0)) > 0:
            m = np.broadcast_to(np.eye(k, dtype=np.float32), (n, k, k)).copy()
            for t in range(self.steps):
                rows = self.live[t]
                m[:rows] = _norm((m[:rows] @ a) * e[start[:rows] + t][:, None, :])
            matrix = np.empty_like(m)
            matrix[self.order] = m
            for step in range(1, int(self.nth.max()) + 1):
                at = np.flatnonzero(self.nth == step)
                entry[at] = _norm(np.einsum("ni,nij->nj", entry[at - 1], matrix[at - 1]))
            for step in range(int(self.nth.max()), 0, -1):
                at = np.flatnonzero(self.nth == step)
                leave[at - 1] = _norm(np.einsum("nij,nj->ni", matrix[at], leave[at]))
        before = entry[self.order]
        alpha = np.empty_like(e)
        for t in range(self.steps):
            rows = self.live[t]
            before[:rows] = _norm((before[:rows] @ a) * e[start[:rows] + t])
            alpha[start[:rows] + t] = before[:rows]
        entry, beta = entry[self.order], leave[self.order]
        out = np.empty_like(e)
        for t in range(self.steps - 1, -1, -1):
            rows = self.live[t]
            at = start[:rows] + t
            out[at] = _norm(alpha[at] * beta[:rows])
            ahead = e[at] * beta[:rows]
            past = alpha[at - 1] if t else entry
            if pairs is not None:
                weight = np.einsum("ni,ij,nj->n", past[:rows], a, ahead)
                pairs += a * ((past[:rows] / weight[:, None]).T @ ahead)
            beta[:rows] = _norm(ahead @ a.T)
        return out

    def text_sums(self, x: np.ndarray, n_texts: int) -> np.ndarray:
        """Sums of a per-word array over each text."""
        seg = np.add.reduceat(x, self.start, axis=0) if len(self.start) else np.zeros((0, x.shape[1]))
        return np.stack([np.bincount(self.text, seg[:, j], n_texts) for j in range(x.shape[1])], axis=1)


def parts(first: np.ndarray, k: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts whose chains are handled together, the smaller the more labels there are."""
    count = np.diff(first)
    cells = np.cumsum(count * k + -(-count // SEGMENT) * k * k)
    cuts = np.flatnonzero(np.diff(cells // CELLS)) + 1
    return itertools.pairwise([0, *cuts.tolist(), len(count)])


def sticky(k: int, stay: float) -> np.ndarray:
    if k == 1:
        return np.zeros((1, 1))
    out = np.full((k, k), (1 - stay) / (k - 1))
    np.fill_diagonal(out, stay)
    return np.log(out)


def fit(texts, label_of: np.ndarray, labels: list[str], rounds: int = 30, chain_rounds: int = 8, decay: float = 1e-5) -> Model:
    """Train on texts of one main language each.

    The words first have their text's label, and the scores are fitted alone. A sticky
    chain of these scores then relabels words in foreign passages, and scores and
    transitions are fitted together by the gradient of the forward-backward marginals.
    """
    k = len(labels)
    words = W.folded(texts, W.NO_LETTER)
    some, keys, which = distinct(words)
    n = len(keys)
    of_text = label_of[words.text_of]
    seen = np.stack([np.bincount(which[of_text == y], minlength=n) for y in range(k)], axis=1)
    lexicons = []
    for y in range(k):
        top = np.argsort(-seen[:, y], kind="stable")[:LEXICON]
        lexicons.append(np.sort(keys[top[seen[top, y] >= SEEN]]))
    found, of = features(some, lexicons, keys)
    weights, energy = np.zeros((BUCKETS, k)), np.full((BUCKETS, k), 1e-8)
    chains = [
        (slice(words.first[a], words.first[b]), Chain(words.first[a : b + 1] - words.first[a]))
        for a, b in parts(words.first, k)
    ]

    def step(gap: np.ndarray) -> None:
        nonlocal weights
        grad = np.stack([np.bincount(found, gap[of, y], BUCKETS) for y in range(k)], axis=1)
        grad = grad / max(1, len(which)) - decay * weights
        energy[:] += grad**2
        weights = weights + 0.5 * grad / np.sqrt(energy)

    # Languages count alike, whatever their share of the sample.
    share = seen / np.maximum(seen.sum(axis=0, keepdims=True), 1) * len(which) / k
    for _ in range(rounds):
        p = emissions(found, of, n, weights)
        p = p / p.sum(axis=1, keepdims=True)
        step(share - p * share.sum(axis=1, keepdims=True))

    transitions = sticky(k, 0.95)
    e, a = emissions(found, of, n, weights), np.exp(transitions).astype(np.float32)
    truth = np.concatenate([chain.marginals(e[which[own]], a).argmax(axis=1) for own, chain in chains])
    target = np.stack([np.bincount(which[truth == y], minlength=n) for y in range(k)], axis=1)
    inner = np.ones(len(which), dtype=bool)
    inner[words.first[:-1][np.diff(words.first) > 0]] = False
    last = np.flatnonzero(inner)
    real = np.bincount(truth[last - 1] * k + truth[last], minlength=k * k).reshape(k, k) + 1.0
    speed = np.full((k, k), 1e-8)
    for _ in range(chain_rounds):
        pairs = np.zeros((k, k))
        e, a = emissions(found, of, n, weights), np.exp(transitions).astype(np.float32)
        mean = np.zeros((n, k))
        for own, chain in chains:
            gamma = chain.marginals(e[which[own]], a, pairs)
            for y in range(k):
                mean[:, y] += np.bincount(which[own], gamma[:, y], n)
        step(target - mean)
        grad = (real - pairs) / real.sum()
        speed += grad**2
        transitions = transitions + 0.2 * grad / np.sqrt(speed)
    bits = np.zeros(1 << 24, dtype=bool)
    bits[_trigrams(some)[0]] = True
    spelled = np.packbits(bits, bitorder="little")
    return Model(labels, weights.astype(np.float32), transitions.astype(np.float32), lexicons, spelled)


def shares(model: Model, texts) -> np.ndarray:
    """Per text the mean marginal of each label over its words; zeros without words."""
    words = W.folded(texts, W.NO_LETTER)
    n_texts = len(words.first) - 1
    if not len(words.start):
        return np.zeros((n_texts, len(model.labels)))
    some, keys, which = distinct(words)
    found, of = features(some, model.lexicons, keys)
    e, a = emissions(found, of, len(keys), model.weights), np.exp(model.transitions)
    sums = np.zeros((n_texts, len(model.labels)))
    for lo, hi in parts(words.first, len(model.labels)):
        first = words.first[lo : hi + 1]
        chain = Chain(first - first[0])
        sums[lo:hi] = chain.text_sums(chain.marginals(e[which[first[0] : first[-1]]], a), hi - lo)
    return sums / np.maximum(words.counts, 1)[:, None]
