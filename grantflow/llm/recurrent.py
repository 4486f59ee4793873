"""Bidirectional recurrent layers in numpy, trained by backpropagation through time.

Arrays are feature-major, ``[..., features, batch]``, so that every operation runs along the batch. Both directions
run side by side: gate inputs are ``[time, 2, gates, batch]`` where direction 1 holds the sequence backwards; ``flip``
puts its outputs back in order.
"""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    with np.errstate(over="ignore"):
        np.negative(x, out=x)
        np.exp(x, out=x)
        x += 1
        return np.reciprocal(x, out=x)


def tanh(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= 2
    sigmoid(x)
    x *= 2
    x -= 1
    return x


def flip(h: np.ndarray) -> np.ndarray:
    """``[time, 2, h, batch]`` as ``[time, 2h, batch]`` with both directions at the same position."""
    return np.concatenate([h[:, 0], h[::-1, 1]], axis=1)


def unflip(d: np.ndarray) -> np.ndarray:
    half = d.shape[1] // 2
    return np.stack([d[:, :half], d[::-1, half:]], axis=1)


def both_ways(index: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Gate inputs of ``index`` [time, batch] from ``table`` [2, rows, gates]."""
    steps, batch = index.shape
    out = np.empty((steps, 2, table.shape[2], batch), dtype=np.float32)
    for t in range(steps):
        out[t, 0] = table[0][index[t]].T
        out[t, 1] = table[1][index[steps - 1 - t]].T
    return out


def add_rows(index: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """Sum of ``values`` [n, k] by row: [rows, k]."""
    return np.stack([np.bincount(index, v, rows) for v in values.T], axis=1).astype(np.float32)


def table_gradient(index: np.ndarray, d: np.ndarray, rows: int) -> np.ndarray:
    """Sum of ``d`` [time, 2, gates, batch] by table row: [2, rows, gates]."""
    gates = d.shape[2]
    return np.stack([
        add_rows(i.ravel(), d[:, k].transpose(0, 2, 1).reshape(-1, gates), rows)
        for k, i in enumerate((index, index[::-1]))
    ])


class Gru:
    """Gated recurrent units; ``u`` is [2, 3h, h] for the update, reset and candidate gates."""

    gates = 3

    @staticmethod
    def forward(gx: np.ndarray, u: np.ndarray, keep: bool = False):
        steps, _, width, batch = gx.shape
        size = width // 3
        h = np.zeros((2, size, batch), dtype=np.float32)
        out = np.empty((steps, 2, size, batch), dtype=np.float32)
        kept = []
        for t in range(steps):
            hu = u @ h
            zr = hu[:, : 2 * size] + gx[t, :, : 2 * size]
            sigmoid(zr)
            n = hu[:, 2 * size :] * zr[:, size:]
            n += gx[t, :, 2 * size :]
            tanh(n)
            if keep:
                kept.append((h, zr, n, hu[:, 2 * size :]))
            after = out[t]
            np.subtract(h, n, out=after)
            after *= zr[:, :size]
            after += n
            h = after
        return out, kept

    @staticmethod
    def backward(d_out: np.ndarray, u: np.ndarray, kept: list):
        steps, _, size, batch = d_out.shape
        d_gx = np.empty((steps, 2, 3 * size, batch), dtype=np.float32)
        d_u = np.zeros_like(u)
        d_h = np.zeros((2, size, batch), dtype=np.float32)
        for t in range(steps - 1, -1, -1):
            before, zr, n, hn = kept[t]
            z, r = zr[:, :size], zr[:, size:]
            d_h = d_h + d_out[t]
            d_n = d_h * (1 - z) * (1 - n * n)
            d_gx[t, :, :size] = d_h * (before - n) * z * (1 - z)
            d_gx[t, :, size : 2 * size] = d_n * hn * r * (1 - r)
            d_gx[t, :, 2 * size :] = d_n
            d_hu = d_gx[t].copy()
            d_hu[:, 2 * size :] *= r
            d_u += d_hu @ before.transpose(0, 2, 1)
            d_h = d_h * z + u.transpose(0, 2, 1) @ d_hu
        return d_gx, d_u


class Lstm:
    """Long short-term memory; ``u`` is [2, 4h, h] for the input, forget, output and cell gates."""

    gates = 4

    @staticmethod
    def forward(gx: np.ndarray, u: np.ndarray, keep: bool = False):
        steps, _, width, batch = gx.shape
        size = width // 4
        h = np.zeros((2, size, batch), dtype=np.float32)
        c = np.zeros_like(h)
        out = np.empty((steps, 2, size, batch), dtype=np.float32)
        kept = []
        for t in range(steps):
            g = u @ h
            g += gx[t]
            ifo = sigmoid(g[:, : 3 * size])
            cell = tanh(g[:, 3 * size :])
            before_h, before_c = h, c
            c = ifo[:, size : 2 * size] * c + ifo[:, :size] * cell
            tc = tanh(c.copy())
            h = ifo[:, 2 * size :] * tc
            out[t] = h
            if keep:
                kept.append((before_h, before_c, ifo, cell, tc))
        return out, kept

    @staticmethod
    def backward(d_out: np.ndarray, u: np.ndarray, kept: list):
        steps, _, size, batch = d_out.shape
        d_gx = np.empty((steps, 2, 4 * size, batch), dtype=np.float32)
        d_u = np.zeros_like(u)
        d_h = np.zeros((2, size, batch), dtype=np.float32)
        d_c = np.zeros_like(d_h)
        for t in range(steps - 1, -1, -1):
            before_h, before_c, ifo, cell, tc = kept[t]
            i, f, o = ifo[:, :size], ifo[:, size : 2 * size], ifo[:, 2 * size :]
            d_h = d_h + d_out[t]
            d_c = d_c + d_h * o * (1 - tc * tc)
            d_gx[t, :, :size] = d_c * cell * i * (1 - i)
            d_gx[t, :, size : 2 * size] = d_c * before_c * f * (1 - f)
            d_gx[t, :, 2 * size : 3 * size] = d_h * tc * o * (1 - o)
            d_gx[t, :, 3 * size :] = d_c * i * (1 - cell * cell)
            d_u += d_gx[t] @ before_h.transpose(0, 2, 1)
            d_h = u.transpose(0, 2, 1) @ d_gx[t]
            d_c = d_c * f
        return d_gx, d_u


class Adam:
    """Updates a dict of arrays in place; gradients are clipped by their common norm."""

    def __init__(self, params: dict[str, np.ndarray], rate: float, clip: float = 5.0):
        self.params, self.rate, self.clip, self.step = params, rate, clip, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def update(self, grads: dict[str, np.ndarray]) -> None:
        self.step += 1
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads.values())))
        scale = min(1.0, self.clip / (norm + 1e-9))
        rate = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        for k, g in grads.items():
            g = g * scale
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.params[k] -= (rate * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)).astype(np.float32)


def uniform(rng: np.random.Generator, *shape: int, scale: float) -> np.ndarray:
    return rng.uniform(-scale, scale, shape).astype(np.float32)
