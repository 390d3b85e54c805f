"""Small numpy networks: a text CNN over looked-up embeddings, and a two-layer network."""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 18       # places whose responses are held at a time


class Adagrad:
    """Per-parameter steps; rows of a table may be updated alone."""

    FIRST = 1e-6

    def __init__(self, rate: float):
        self.rate, self.state = rate, {}

    def step(self, key, param: np.ndarray, grad: np.ndarray, rows: np.ndarray | None = None) -> None:
        if key not in self.state:
            self.state[key] = np.full(param.shape, self.FIRST, np.float32)
        seen = self.state[key]
        if rows is None:
            seen += grad * grad
            param -= self.rate * grad / np.sqrt(seen)
        else:
            seen[rows] += grad * grad
            param[rows] -= self.rate * grad / np.sqrt(seen[rows])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class TextCNN:
    """Embeddings, filters of several widths, max pooling, and linear heads.

    A batch is a flat run of segments.  ``ids`` has one column per embedding
    table; each segment ends with ``pad`` rows of the tables' last, all-zero
    entry, so that no filter sees two segments.
    """

    def __init__(self, sizes: list[int], dim: int, widths: tuple[int, ...], filters: int, heads: dict[str, int], seed: int):
        rng = np.random.default_rng(seed)
        self.sizes, self.dim, self.widths, self.pad = sizes, dim, widths, max(widths) - 1
        self.tables = [np.concatenate([rng.normal(0, 0.3, (n, dim)), np.zeros((1, dim))]).astype(np.float32) for n in sizes]
        each = dim * len(sizes)
        self.conv = np.zeros((max(widths) * each, filters * len(widths)), np.float32)
        self.mask = np.zeros_like(self.conv)
        for k, w in enumerate(widths):
            block = (slice(0, w * each), slice(k * filters, (k + 1) * filters))
            self.conv[block] = rng.normal(0, (2.0 / (w * each)) ** 0.5, (w * each, filters))
            self.mask[block] = 1.0
        self.bias = np.zeros(self.conv.shape[1], np.float32)
        self.heads = {k: [rng.normal(0, 0.1, (self.conv.shape[1], n)).astype(np.float32), np.zeros(n, np.float32)]
                      for k, n in heads.items()}

    def _patches(self, ids: np.ndarray) -> np.ndarray:
        x = np.concatenate([t[ids[:, k]] for k, t in enumerate(self.tables)], axis=1)
        x = np.concatenate([x, np.zeros((self.pad, x.shape[1]), np.float32)])
        n = len(ids)
        return np.concatenate([x[j:j + n] for j in range(self.pad + 1)], axis=1)

    def pooled(self, ids: np.ndarray, starts: np.ndarray, places: bool = False):
        """Pooled features of every segment, and the rows that won if ``places``."""
        ends = np.append(starts[1:], len(ids)) - self.pad
        out = np.zeros((len(starts), self.conv.shape[1]), np.float32)
        won = np.zeros(out.shape, np.int64)
        for lo in range(0, len(ids), CHUNK):
            hi = min(lo + CHUNK, len(ids))
            z = self._patches(ids[lo:hi + self.pad])[:hi - lo] @ self.conv
            for i in range(int(np.searchsorted(ends, lo, "right")), int(np.searchsorted(starts, hi, "left"))):
                s, e = max(int(starts[i]), lo), min(int(ends[i]), hi)
                if e <= s:
                    continue
                part = z[s - lo:e - lo]
                if places:
                    at = part.argmax(axis=0)
                    most = part[at, np.arange(part.shape[1])]
                    better = most > out[i] if s > starts[i] else np.ones(len(most), bool)
                    won[i] = np.where(better, at + s, won[i])
                else:
                    most = part.max(axis=0)
                out[i] = np.maximum(out[i], most) if s > starts[i] else most
        out[ends > starts] += self.bias
        np.maximum(out, 0, out=out)
        return (out, won) if places else out

    def logits(self, pooled: np.ndarray, head: str) -> np.ndarray:
        w, b = self.heads[head]
        return pooled @ w + b

    def parameters(self) -> dict:
        """All arrays that are learnt, by their key in :class:`Adagrad`."""
        named = {("table", k): t for k, t in enumerate(self.tables)} | {"conv": self.conv, "bias": self.bias}
        return named | {(name, k): a for name, both in self.heads.items() for k, a in enumerate(both)}

    def train(self, batches, epochs: int, rate: float) -> None:
        """``batches(epoch)`` yields ``(ids, starts, {head: (classes, weights)})``; cross entropy by head."""
        opt = Adagrad(rate)
        for epoch in range(epochs):
            for ids, starts, goals in batches(epoch):
                self.step(opt, ids, starts, goals)

    def step(self, opt: Adagrad, ids: np.ndarray, starts: np.ndarray, goals: dict) -> None:
        """Learn from one batch."""
        each = self.dim * len(self.tables)
        pooled, won = self.pooled(ids, starts, places=True)
        back = np.zeros_like(pooled)
        for name, (classes, weights) in goals.items():
            g = softmax(self.logits(pooled, name))
            g[np.arange(len(classes)), classes] -= 1.0
            g *= (weights / max(1.0, weights.sum()))[:, None]
            w, b = self.heads[name]
            back += g @ w.T
            opt.step((name, 0), w, pooled.T @ g)
            opt.step((name, 1), b, g.sum(axis=0))
        back *= pooled > 0
        opt.step("bias", self.bias, back.sum(axis=0))
        seg, col = np.nonzero(back)
        if not len(seg):
            return
        at, grad = won[seg, col], back[seg, col]
        rows = at[:, None] + np.arange(self.pad + 1)
        real = rows < len(ids)
        rows = np.minimum(rows, len(ids) - 1)
        patch = np.concatenate([t[ids[rows, k]] for k, t in enumerate(self.tables)], axis=2) * real[..., None]
        dconv = np.zeros_like(self.conv)
        np.add.at(dconv.T, col, patch.reshape(len(at), -1) * grad[:, None])
        dx = (self.conv.T[col] * grad[:, None]).reshape(len(at), self.pad + 1, each)
        opt.step("conv", self.conv, dconv * self.mask)
        for k, t in enumerate(self.tables):
            touched, inverse = np.unique(ids[rows, k][real], return_inverse=True)
            g = np.zeros((len(touched), self.dim), np.float32)
            np.add.at(g, inverse, dx[..., k * self.dim:(k + 1) * self.dim][real])
            g[touched == self.sizes[k]] = 0.0
            opt.step(("table", k), t, g, touched)


class TwoLayer:
    """Standardised features, one hidden layer, one probability; temperature from rows kept aside."""

    def __init__(self, x: np.ndarray, y: np.ndarray, aside: np.ndarray, hidden: int = 32, epochs: int = 60,
                 rate: float = 0.05, decay: float = 1e-4, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        self.w1 = rng.normal(0, (1.0 / x.shape[1]) ** 0.5, (x.shape[1], hidden)).astype(np.float32)
        self.b1, self.w2, self.b2 = np.zeros(hidden, np.float32), rng.normal(0, 0.1, (hidden, 1)).astype(np.float32), np.zeros(1, np.float32)
        self.temperature = 1.0
        z = ((x - self.mean) / self.scale).astype(np.float32)
        fit, opt = np.flatnonzero(~aside), Adagrad(rate)
        for _ in range(epochs):
            rng.shuffle(fit)
            for at in range(0, len(fit), 256):
                rows = fit[at:at + 256]
                h = np.tanh(z[rows] @ self.w1 + self.b1)
                g = (1.0 / (1.0 + np.exp(-(h @ self.w2 + self.b2))) - y[rows, None]) / len(rows)
                g = g.astype(np.float32)
                dh = (g @ self.w2.T) * (1 - h * h)
                opt.step(0, self.w2, h.T @ g + decay * self.w2)
                opt.step(1, self.b2, g.sum(axis=0))
                opt.step(2, self.w1, z[rows].T @ dh + decay * self.w1)
                opt.step(3, self.b1, dh.sum(axis=0))
        if aside.any():
            logit, t = self.logit(x[aside]), y[aside]
            loss = lambda k: np.mean(np.logaddexp(0.0, np.where(t > 0, -logit, logit) / k))
            self.temperature = float(min(np.geomspace(0.25, 8.0, 101), key=loss))

    def logit(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh(((x - self.mean) / self.scale).astype(np.float32) @ self.w1 + self.b1)
        return (h @ self.w2 + self.b2)[:, 0].astype(np.float64)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.logit(x) / self.temperature))
