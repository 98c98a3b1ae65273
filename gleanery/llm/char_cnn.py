"""A small character convolutional network in numpy, with calibrated scores and a recall-constrained threshold."""

import math
from collections.abc import Callable

import numpy as np

PAD, SPACE, OTHER = 0, 96, 97
N_CODES = 98
EMBEDDING = 8
WIDTH = 5
FILTERS = 24


def codes(text: str) -> np.ndarray:
    """Printable ASCII characters have a code each; white space shares one, and so do all others."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    found = np.full(len(points), OTHER, np.int64)
    plain = (points > 32) & (points < 127)
    found[plain] = points[plain] - 32
    found[np.isin(points, (9, 10, 11, 12, 13, 32))] = SPACE
    return found


def padded(windows: list[tuple[str, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of windows (text, start and end of the candidate in it), and which places are the candidate's."""
    length = max(len(w[0]) for w in windows)
    ids = np.zeros((len(windows), length), np.int64)
    inside = np.zeros((len(windows), length))
    for i, (text, start, end) in enumerate(windows):
        ids[i, : len(text)] = codes(text)
        inside[i, start:end] = 1
    return ids, inside


class CharNet:
    """Embedding, one convolution, the maximum over all places and the mean over the candidate's, and a logistic unit."""

    def __init__(self, seed: int = 7) -> None:
        draw = np.random.default_rng(seed)
        depth = EMBEDDING + 1
        self.weights = {
            "embedding": draw.normal(0, 0.3, (N_CODES, EMBEDDING)),
            "filters": draw.normal(0, 1 / math.sqrt(WIDTH * depth), (WIDTH * depth, FILTERS)),
            "bias": np.zeros(FILTERS),
            "out": draw.normal(0, 0.1, 2 * FILTERS),
            "shift": np.zeros(1),
        }
        self.first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        self.steps = 0
        self.slope, self.offset, self.threshold = 1.0, 0.0, math.inf

    def _forward(self, ids: np.ndarray, inside: np.ndarray) -> tuple:
        w = self.weights
        x = np.concatenate([w["embedding"][ids], inside[..., None]], axis=2)
        reach = WIDTH // 2
        wide = np.pad(x, ((0, 0), (reach, reach), (0, 0)))
        columns = np.concatenate([wide[:, j : j + x.shape[1]] for j in range(WIDTH)], axis=2)
        valid = (ids != PAD)[..., None]
        hidden = np.maximum(columns @ w["filters"] + w["bias"], 0) * valid
        share = inside / np.maximum(inside.sum(axis=1, keepdims=True), 1)
        pooled = np.concatenate([hidden.max(axis=1), np.einsum("nlf,nl->nf", hidden, share)], axis=1)
        return pooled @ w["out"] + w["shift"][0], pooled, hidden, columns, share

    def logits(self, ids: np.ndarray, inside: np.ndarray) -> np.ndarray:
        return self._forward(ids, inside)[0]

    def gradients(self, ids: np.ndarray, inside: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        z, pooled, hidden, columns, share = self._forward(ids, inside)
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) / len(labels)
        into = error[:, None] * w["out"]
        d_hidden = into[:, None, FILTERS:] * share[..., None]
        rows, filters = np.indices(pooled[:, :FILTERS].shape)
        d_hidden[rows, hidden.argmax(axis=1), filters] += into[:, :FILTERS]
        d_hidden *= hidden > 0
        flat = d_hidden.reshape(-1, FILTERS)
        d_columns = (flat @ w["filters"].T).reshape(columns.shape)
        reach, depth = WIDTH // 2, EMBEDDING + 1
        d_wide = np.zeros((ids.shape[0], ids.shape[1] + 2 * reach, depth))
        for j in range(WIDTH):
            d_wide[:, j : j + ids.shape[1]] += d_columns[:, :, j * depth : (j + 1) * depth]
        d_embedding = np.zeros_like(w["embedding"])
        np.add.at(d_embedding, ids.ravel(), d_wide[:, reach : reach + ids.shape[1], :EMBEDDING].reshape(-1, EMBEDDING))
        return {
            "embedding": d_embedding,
            "filters": columns.reshape(-1, columns.shape[2]).T @ flat,
            "bias": flat.sum(axis=0),
            "out": pooled.T @ error,
            "shift": np.array([error.sum()]),
        }

    def state(self) -> np.ndarray:
        """The weights and both moments of Adam, in one row."""
        return np.concatenate([part[k].ravel() for part in (self.weights, self.first, self.second) for k in self.weights])

    def restore(self, state: np.ndarray) -> None:
        at = 0
        for part in (self.weights, self.first, self.second):
            for k, w in self.weights.items():
                part[k] = state[at : at + w.size].reshape(w.shape).copy()
                at += w.size

    def train(
        self, windows: list[tuple[str, int, int]], labels: np.ndarray, draw: np.random.Generator, size: int = 64, rate: float = 0.01
    ) -> int:
        """An epoch of Adam over shuffled batches; returns its steps. Half of the windows lose their context, so that the
        candidate's own characters have to tell as well; both classes weigh the same."""
        classes = [np.flatnonzero(labels == c) for c in (0, 1)]
        n = max(map(len, classes))
        order = draw.permutation(np.concatenate([draw.choice(c, n, replace=len(c) < n) for c in classes]))
        for at in range(0, len(order), size):
            pick = order[at : at + size]
            batch = [windows[i] for i in pick]
            bare = draw.random(len(batch)) < 0.5
            batch = [(t[a:b], 0, b - a) if x else (t, a, b) for (t, a, b), x in zip(batch, bare)]
            self.steps += 1
            for k, g in self.gradients(*padded(batch), labels[pick]).items():
                self.first[k] = 0.9 * self.first[k] + 0.1 * g
                self.second[k] = 0.999 * self.second[k] + 0.001 * g * g
                scale = math.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
                self.weights[k] = self.weights[k] - rate * scale * self.first[k] / (np.sqrt(self.second[k]) + 1e-8)
        return -(-len(order) // size)

    def scores(self, windows: list[tuple[str, int, int]]) -> np.ndarray:
        """Calibrated probabilities. Windows are scored with others of about their length, in bounded batches."""
        found = np.zeros(len(windows))
        order = sorted(range(len(windows)), key=lambda i: len(windows[i][0]))
        at = 0
        while at < len(order):
            width = max(64, 1 << (len(windows[order[at]][0]) - 1).bit_length())
            rows = max(1, (1 << 15) // width)
            pick = [i for i in order[at : at + rows] if len(windows[i][0]) <= width]
            z = self.logits(*padded([windows[i] for i in pick]))
            found[pick] = 1 / (1 + np.exp(-np.clip(self.slope * z + self.offset, -30, 30)))
            at += len(pick)
        return found

    def calibrate(self, sums: Callable[[float, float], np.ndarray]) -> None:
        """Platt scaling by Newton steps on two parameters.

        `sums(a, b)` adds up, over all held-out windows, with q the chance at slope a and offset b, the target less q and
        w = q (1 - q): (q - target) z, q - target, w z z, w z, w.
        """
        a, b = 1.0, 0.0
        for _ in range(30):
            gz, g, wzz, wz, w = sums(a, b)
            move = np.linalg.solve(np.array([[wzz + 1e-3, wz], [wz, w + 1e-3]]), np.array([gz, g]))
            a, b = a - float(np.clip(move[0], -1, 1)), b - float(np.clip(move[1], -1, 1))
            if np.abs(move).max() < 1e-9:
                break
        self.slope, self.offset = a, b

    def constrain(self, scores: np.ndarray, recall: float, level: float) -> None:
        """The highest threshold at which the recall is `recall` or more with confidence 1 - `level`. With too few findings
        nothing can be shown and nothing passes."""
        m = misses_allowed(len(scores), recall, level)
        self.threshold = float(np.sort(scores)[m]) if m >= 0 else math.inf


def misses_allowed(n: int, recall: float, level: float) -> int:
    """Of n held-out findings, as many m may be missed as keep the binomial probability of m or fewer misses, at a miss rate
    of 1 - recall, within the level; -1 if not even none. Terms are taken from logarithms: their first ones may be too small for a double."""
    miss, total, m = 1 - recall, 0.0, -1
    while m + 1 < n:
        k = m + 1
        total += math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(miss) + (n - k) * math.log1p(-miss))
        if total > level:
            break
        m = k
    return m
