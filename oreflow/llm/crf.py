"""A linear-chain conditional random field over word-shape features, in numpy."""

from __future__ import annotations

import numpy as np

# Character classes of the shapes; everything else counts as a letter.
SPACE, LOWER, UPPER, DIGIT, AT, DOT, DASH, PLUS, PAREN, SLASH, COLON, MARK = range(12)
_CLASS = np.full(65_536, LOWER, np.uint8)
for _chars, _c in (
    (" \t\n\x0b\x0c\r", SPACE),
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", UPPER),
    ("0123456789", DIGIT),
    ("@", AT),
    (".", DOT),
    ("-", DASH),
    ("+", PLUS),
    ("()", PAREN),
    ("/", SLASH),
    (":", COLON),
    (",;!?\"'#$%&*=<>[]{}|\\^`~_", MARK),
):
    for _x in _chars:
        _CLASS[ord(_x)] = _c

# Upper edges of the buckets that counts of a class in a word fall into.
_COUNTED = {
    DIGIT: (0, 1, 2, 3, 4, 6, 9, 12, 13, 19),
    AT: (0, 1),
    DOT: (0, 1, 2, 3),
    DASH: (0, 1, 2, 3),
    PAREN: (0, 1, 2),
    SLASH: (0,),
    COLON: (0,),
    MARK: (0, 1),
    LOWER: (0, 1, 3),
    UPPER: (0,),
}
_SIZES = [len(edges) + 1 for edges in _COUNTED.values()] + [12, 12]
# Each feature of a word, of the word before it and of the word after it, has weights of its own.
N_FEATURES = 3 * (sum(_SIZES) + 1)


def shapes(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and its features (one column of indexes per feature)."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    classes = _CLASS[np.minimum(points, 65_535)]
    inside = np.concatenate(([False], classes != SPACE, [False]))
    starts = np.flatnonzero(~inside[:-1] & inside[1:])
    ends = np.flatnonzero(inside[:-1] & ~inside[1:])
    if not len(starts):
        return starts, ends, np.zeros((0, 3 * len(_SIZES)), np.int32)
    columns, base = [], 0
    for c, edges in _COUNTED.items():
        counts = np.add.reduceat(classes == c, starts, dtype=np.int32)
        columns.append(np.searchsorted(edges, counts).astype(np.int32) + base)
        base += len(edges) + 1
    for place in (starts, ends - 1):
        columns.append(classes[place].astype(np.int32) + base)
        base += 12
    own = np.stack(columns, axis=1)
    edge = np.full((1, own.shape[1]), base, np.int32)
    before = np.concatenate((edge, own[:-1])) + (base + 1)
    after = np.concatenate((own[1:], edge)) + 2 * (base + 1)
    return starts, ends, np.concatenate((own, before, after), axis=1)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Crf:
    """Weights per feature and label, and per pair of neighbouring labels."""

    def __init__(self, n_labels: int):
        self.emission = np.zeros((N_FEATURES, n_labels))
        self.transition = np.zeros((n_labels, n_labels))

    def scores(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), self.emission.shape[1]))
        for k in range(features.shape[1]):
            out += self.emission[features[:, k]]
        return out

    def _gradient(self, features: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Log-likelihood and its gradient for one labelled text, by forward and backward sums."""
        n, k = len(labels), self.transition.shape[0]
        e = self.scores(features)
        forward, backward = np.zeros((n, k)), np.zeros((n, k))
        forward[0] = e[0]
        for t in range(1, n):
            forward[t] = e[t] + _log_sum(forward[t - 1][:, None] + self.transition, 0)
        for t in range(n - 2, -1, -1):
            backward[t] = _log_sum(self.transition + (e[t + 1] + backward[t + 1])[None, :], 1)
        z = _log_sum(forward[-1], 0)
        grad_e, grad_t = np.zeros_like(self.emission), np.zeros_like(self.transition)
        wrong = np.eye(k)[labels] - np.exp(forward + backward - z)
        for j in range(features.shape[1]):
            np.add.at(grad_e, features[:, j], wrong)
        for t in range(1, n):
            both = forward[t - 1][:, None] + self.transition + (e[t] + backward[t])[None, :]
            grad_t -= np.exp(both - z)
            grad_t[labels[t - 1], labels[t]] += 1
        path = e[np.arange(n), labels].sum() + self.transition[labels[:-1], labels[1:]].sum()
        return path - z, grad_e, grad_t

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], rounds: int = 25, rate: float = 0.2, decay: float = 1e-3):
        """Stochastic ascent with per-weight step sizes; the order of rows is fixed by a seed."""
        rng = np.random.default_rng(7)
        squares = [np.full_like(self.emission, 1e-8), np.full_like(self.transition, 1e-8)]
        weights = [self.emission, self.transition]
        for _ in range(rounds):
            for i in rng.permutation(len(rows)):
                _, *grads = self._gradient(*rows[i])
                for w, s, g in zip(weights, squares, grads, strict=True):
                    g -= decay * w
                    s += g * g
                    w += rate * g / np.sqrt(s)
        return self

    def decode(self, features: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The best label of every word of texts that lie one after the other; by Viterbi.

        All texts take a step together: the longest first, so that those still running are a prefix.
        """
        lengths = np.asarray(lengths, np.int64)
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        e = self.scores(features)
        best = np.zeros(len(e), np.int8)
        if not len(e):
            return best
        back = np.zeros(e.shape, np.int8)
        running = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # texts longer than t
        state = np.zeros((len(lengths), e.shape[1]))
        state[: running[0]] = e[starts[: running[0]]]
        for t in range(1, lengths[0]):
            n = running[t]
            at = starts[:n] + t
            options = state[:n, :, None] + self.transition
            back[at] = options.argmax(axis=1)
            state[:n] = options.max(axis=1) + e[at]
        label = state.argmax(axis=1)
        for t in range(lengths[0] - 1, -1, -1):
            n = running[t]
            at = starts[:n] + t
            best[at] = label[:n]
            label[:n] = back[at, label[:n]]
        return best
