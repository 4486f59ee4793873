"""Toxicity: a bidirectional gated recurrent network over words with attention pooling.

A word's input is its own vector (words known from training) and the mean vector of its character n-grams, so that
unknown and disguised words are read by their letters. Texts are read whole in windows of ``WINDOW`` words that
overlap by half; attention pools the outputs of a window into one logit, and the highest window decides, since a text
is as toxic as its worst passage. A logistic calibration on the training rows turns the logit into a probability.

Training: at most ``MAX_TOXIC`` toxic and ``MAX_CLEAN`` other labelled documents, chosen by a hash of the id; the bound
doesn't grow with the corpus. Their texts are taken whole.

Defined results: null text and text without a word has score 0; without labels of both classes every score is 0;
labels other than 0 and 1 are not learned from; a document with several labels counts as toxic if one says so; rows
without id are scored and count as not held out; repeated rows give repeated rows; an empty table gives an empty
table; further columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantflow.llm.common import keyed, pick, row_key, small, staged
from grantflow.llm.recurrent import Adam, Gru, add_rows, both_ways, flip, table_gradient, tanh, uniform, unflip

MAX_TOXIC = 700
MAX_CLEAN = 1000
WINDOW, STRIDE = 32, 16
SIZE, DIM, GRAMS, BUCKETS = 8, 8, (3, 4, 5), 1 << 14
TABLE = 100_000  # words whose gate inputs are kept at once in a task
EDGES = re.compile(r"^[\W_]+|[\W_]+$")


class Model(NamedTuple):
    words: dict[str, int]
    params: dict[str, np.ndarray]
    scale: float
    shift: float


def normal(token: str) -> str:
    return EDGES.sub("", token)


def gram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of all words, edges marked, and the word each belongs to."""
    text = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    word = np.repeat(np.arange(len(words)), sizes)
    buckets, owner = [], []
    for n in GRAMS:
        if len(text) < n:
            continue
        code = np.zeros(len(text) - n + 1, dtype=np.uint64)
        for i in range(n):
            code = code * np.uint64(0x9E3779B97F4A7C15) + text[i : len(text) - n + 1 + i] + np.uint64(n)
        inside = word[: len(code)] == word[n - 1 :]
        code ^= code >> np.uint64(29)
        code *= np.uint64(0xBF58476D1CE4E5B9)
        buckets.append((code[inside] >> np.uint64(40)).astype(np.int64) % BUCKETS)
        owner.append(word[: len(code)][inside])
    return np.concatenate(buckets or [np.zeros(0, np.int64)]), np.concatenate(owner or [np.zeros(0, np.int64)])


def mean_by(owner: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    count = np.maximum(1, np.bincount(owner, minlength=rows))[:, None]
    return np.stack([np.bincount(owner, v, rows) for v in values.T], axis=1) / count


def inputs(words: list[str], known: dict[str, int], p: dict[str, np.ndarray]) -> tuple[np.ndarray, tuple]:
    """Word and character vector of each word side by side; row 0 of the word vectors is for unknown words."""
    ids = np.array([known.get(w, 0) for w in words], dtype=np.int64)
    buckets, owner = gram_buckets(words)
    chars = mean_by(owner, p["grams"][buckets], len(words))
    return np.concatenate([p["words"][ids], chars], axis=1).astype(np.float32), (ids, buckets, owner)


def gate_table(x: np.ndarray, p: dict[str, np.ndarray]) -> np.ndarray:
    """[2, words + 1, gates]; the last row is for the padding after a text."""
    table = x @ p["in"].transpose(0, 2, 1) + p["bias"][:, None]
    return np.concatenate([table, p["pad"][:, None]], axis=1).astype(np.float32)


def pool(h: np.ndarray, mask: np.ndarray, p: dict[str, np.ndarray]):
    """Attention over the positions of each window: its logit and what the gradient needs."""
    a = tanh(p["attend"] @ h)
    e = np.einsum("k,tkb->tb", p["query"], a)
    e = np.where(mask, e, -1e9)
    e -= e.max(axis=0)
    weight = np.exp(e) * mask
    weight /= np.maximum(weight.sum(axis=0), 1e-9)
    pooled = np.einsum("tb,thb->hb", weight, h)
    return p["out"] @ pooled + p["out_bias"][0], (a, weight, pooled)


def pool_gradient(d: np.ndarray, h: np.ndarray, kept: tuple, p: dict[str, np.ndarray]):
    a, weight, pooled = kept
    d_pooled = p["out"][:, None] * d
    d_weight = np.einsum("hb,thb->tb", d_pooled, h)
    d_e = weight * (d_weight - (weight * d_weight).sum(axis=0))
    d_a = p["query"][None, :, None] * d_e[:, None, :] * (1 - a * a)
    d_h = weight[:, None, :] * d_pooled[None] + p["attend"].T @ d_a
    return d_h, {
        "out": pooled @ d, "out_bias": np.array([d.sum()], dtype=np.float32),
        "query": np.einsum("tkb,tb->k", a, d_e), "attend": np.einsum("tkb,thb->kh", d_a, h, optimize=True),
    }


def cut_windows(ids: np.ndarray, pad: int) -> np.ndarray:
    """[time, windows]; the windows cover every word, each but those at the edges twice."""
    starts = np.arange(0, max(1, len(ids) - WINDOW + STRIDE), STRIDE)
    at = starts[None, :] + np.arange(WINDOW)[:, None]
    return np.where(at < len(ids), ids[np.minimum(at, max(0, len(ids) - 1))] if len(ids) else pad, pad)


def window_logits(x: np.ndarray, table: np.ndarray, p: dict[str, np.ndarray], batch: int = 512) -> np.ndarray:
    pad = table.shape[1] - 1
    out = []
    for at in range(0, x.shape[1], batch):
        part = np.ascontiguousarray(x[:, at : at + batch])
        h, _ = Gru.forward(both_ways(part, table), p["u"])
        out.append(pool(flip(h), part != pad, p)[0])
    return np.concatenate(out) if out else np.zeros(0)


def train(texts: list[str], labels: list[int], steps: int = 240, docs: int = 32) -> Model | None:
    """A step looks at all windows of some documents of each label; the highest one of each teaches."""
    rng = np.random.default_rng(11)
    tokens = [[w for w in map(normal, t.lower().split()) if w] for t in texts]
    y = np.array(labels)
    use = np.array([bool(t) for t in tokens], dtype=bool)
    # a fifth of the rows is set aside for the calibration
    aside = use & (np.arange(len(texts)) % 5 == 0)
    groups = [np.flatnonzero(use & ~aside & (y == k)) for k in (0, 1)]
    if not len(groups[0]) or not len(groups[1]):
        return None
    seen = [Counter(), Counter()]
    for i in np.flatnonzero(use & ~aside):
        seen[y[i]].update(set(tokens[i]))
    total = [len(g) for g in groups]
    words = sorted(set().union(*tokens))
    known = {w: i for i, w in enumerate((w for w in words if seen[0][w] + seen[1][w] >= 3), 1)}

    p = {
        "words": uniform(rng, len(known) + 1, DIM, scale=0.1), "grams": uniform(rng, BUCKETS, DIM, scale=0.1),
        "in": uniform(rng, 2, 3 * SIZE, 2 * DIM, scale=0.4), "bias": np.zeros((2, 3 * SIZE), dtype=np.float32),
        "pad": np.zeros((2, 3 * SIZE), dtype=np.float32), "u": uniform(rng, 2, 3 * SIZE, SIZE, scale=0.35),
        "attend": uniform(rng, SIZE, 2 * SIZE, scale=0.3), "query": uniform(rng, SIZE, scale=0.3),
        "out": uniform(rng, 2 * SIZE, scale=0.3), "out_bias": np.full(1, -1, dtype=np.float32),
    }
    # the first number of a vector starts as the log odds of its documents, of a word or of an n-gram
    for w, i in known.items():
        p["words"][i, 0] = np.clip(np.log((seen[1][w] + 2) / total[1] * total[0] / (seen[0][w] + 2)), -2, 2)
    index = {w: i for i, w in enumerate(words)}
    buckets, owner = gram_buckets(words)
    # documents of a class that hold an n-gram's words, summed over the words
    mass = [np.bincount(buckets, np.array([seen[k][w] for w in words], dtype=float)[owner], BUCKETS) for k in (0, 1)]
    p["grams"][:, 0] = np.clip(
        np.log((mass[1] + 5) / (mass[1].sum() + 5) * (mass[0].sum() + 5) / (mass[0] + 5)), -2, 2)

    coded = [np.array([index[w] for w in t], dtype=np.int64) for t in tokens]
    adam = Adam(p, 0.02)
    for step in range(steps):
        adam.rate = 0.02 * (1 - step / steps) + 0.001
        chosen = np.concatenate([rng.choice(g, docs // 2) for g in groups])
        cuts = [cut_windows(coded[i], -1) for i in chosen]
        x = np.concatenate(cuts, axis=1)
        doc = np.repeat(np.arange(len(cuts)), [c.shape[1] for c in cuts])
        local = np.unique(x)
        local = local[local >= 0]
        vectors, (ids, gram, gram_owner) = inputs([words[i] for i in local], known, p)
        table = gate_table(vectors, p)
        pad = len(local)
        x = np.where(x >= 0, np.searchsorted(local, x), pad)
        logits = window_logits(x, table, p)
        # the window that speaks for its document, and of clean ones a second as well
        order = np.lexsort((-logits, doc))
        first = order[np.flatnonzero(np.diff(doc[order], prepend=-1))]
        extra = rng.choice(np.flatnonzero(doc < docs // 2), docs // 2)
        top = np.concatenate([first, extra])
        target = np.concatenate([y[chosen], np.zeros(len(extra))])
        part = np.ascontiguousarray(x[:, top])
        h, kept = Gru.forward(both_ways(part, table), p["u"], keep=True)
        h = flip(h)
        logit, pooled = pool(h, part != pad, p)
        d = ((1 / (1 + np.exp(-logit)) - target) / len(top)).astype(np.float32)
        d_h, grads = pool_gradient(d, h, pooled, p)
        d_gx, grads["u"] = Gru.backward(unflip(d_h), p["u"], kept)
        d_table = table_gradient(part, d_gx, pad + 1)
        grads["pad"] = d_table[:, pad]
        d_table = d_table[:, :pad]
        grads["bias"] = d_table.sum(axis=1)
        grads["in"] = d_table.transpose(0, 2, 1) @ vectors
        d_x = (d_table @ p["in"]).sum(axis=0)
        grads["words"] = add_rows(ids, d_x[:, :DIM], len(p["words"]))
        share = d_x[:, DIM:] / np.maximum(1, np.bincount(gram_owner, minlength=len(local)))[:, None]
        grads["grams"] = add_rows(gram, share[gram_owner], BUCKETS)
        adam.update(grads)

    model = Model(known, p, 1.0, 0.0)
    if len(set(y[aside])) < 2:
        return model
    scale, shift = calibrate(Scorer(model).logits([texts[i] for i in np.flatnonzero(aside)]), y[aside])
    return model._replace(scale=scale, shift=shift)


def calibrate(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic fit of ``y`` on one number by damped Newton steps."""
    center, spread = float(logits.mean()), float(logits.std()) + 1e-6
    z = np.stack([(logits - center) / spread, np.ones(len(logits))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        q = 1 / (1 + np.exp(-z @ w))
        hessian = (z * (q * (1 - q))[:, None]).T @ z + 1e-2 * np.eye(2)
        w -= np.linalg.solve(hessian, z.T @ (q - y) + 1e-2 * w)
    return float(max(w[0], 0.0) / spread), float(w[1] - max(w[0], 0.0) * center / spread)


class Scorer:
    """Scores texts; keeps the gate inputs of the words met so far, a bounded number of them."""

    def __init__(self, model: Model):
        self.model = model
        self.rows: dict[str, int] = {}
        self.parts: list[np.ndarray] = []

    def _table(self, tokens: list[list[str]]) -> np.ndarray:
        if len(self.rows) > TABLE:
            self.rows, self.parts = {}, []
        new = list({t: None for text in tokens for t in text if t not in self.rows})
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            x, _ = inputs([normal(t) for t in part], self.model.words, self.model.params)
            self.rows.update(zip(part, range(len(self.rows), len(self.rows) + len(part)), strict=True))
            self.parts.append(gate_table(x, self.model.params)[:, :-1])
        pad = self.model.params["pad"][:, None]
        self.parts = [np.concatenate(self.parts, axis=1)] if self.parts else []
        return np.concatenate([*self.parts, pad], axis=1)

    def logits(self, texts: list[str]) -> np.ndarray:
        """Highest window logit of each text; -inf without a word."""
        tokens = [t.lower().split() for t in texts]
        table = self._table(tokens)
        pad = table.shape[1] - 1
        rows = self.rows
        out = np.full(len(texts), -np.inf)
        parts, width = [], 0
        for i, t in enumerate(tokens):
            x = cut_windows(np.fromiter((rows[w] for w in t), np.int32, len(t)), pad)
            parts.append((np.full(x.shape[1], i), x))
            width += x.shape[1]
            # the windows of some texts together, not those of all
            if width >= 4096 or i == len(tokens) - 1:
                doc, x = (np.concatenate(c, axis=-1) for c in zip(*parts, strict=True))
                np.maximum.at(out, doc, window_logits(x, table, self.model.params))
                parts, width = [], 0
        out[[not t for t in tokens]] = -np.inf
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        z = np.clip(self.logits(texts), -1e6, None) * self.model.scale + self.model.shift
        score = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
        return np.where([bool(t.split()) for t in texts], score, 0.0)


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column) -> list[tuple[int, str, int]]:
    """The bounded sample: ids are chosen from the narrow tables before any text is read."""
    ids = docs.where(usable & F.col("id").isNotNull()).select("id").distinct()
    labelled = (
        labels.where(F.col("toxic").isin(0, 1)).groupBy("id").agg(F.max("toxic").alias("toxic")).join(ids, "id", "left_semi")
    )
    sample = [
        labelled.where(F.col("toxic") == k).orderBy(F.xxhash64("id"), "id").limit(most)
        for k, most in ((1, MAX_TOXIC), (0, MAX_CLEAN))
    ]
    chosen = {r.id: r.toxic for r in sample[0].union(sample[1]).collect()}
    if not chosen:
        return []
    # whole texts: what marks a document may stand anywhere in it
    texts = (
        docs.where(F.col("id").isin(list(chosen))).select("id", "text").groupBy("id").agg(F.min("text").alias("text"))
    )
    return sorted((r.id, r.text or "", chosen[r.id]) for r in texts.collect())


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    held_out: Column | None = None, key: Column | None = None,
) -> DataFrame:
    """``id, held_out, score, predicted`` per row of ``docs``; ``held_out`` is a condition on ``id``.

    With ``key``, a number made of the columns of ``docs``, also that as ``key``.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"),
        (F.lit(None) if key is None else key).cast("long").alias("key"))
    held_out = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    marks = pick(labels, id_col, label_col).toDF("id", "toxic").where(F.col("id").isNotNull())
    sample = training_rows(rows.select("id", "text"), marks, ~held_out)
    model = train([r[1] for r in sample], [r[2] for r in sample]) if sample else None
    names = ["id", "held_out", "key", "score", "predicted"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model else None
        for batch in small(batches, size=1 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = scorer.scores(texts) if scorer else np.zeros(len(texts))
            columns = [batch.column("id"), batch.column("held_out"), batch.column("key"),
                       pa.array(found, pa.float64()), pa.array((found >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    scored = rows.select("id", held_out.alias("held_out"), "key", "text").mapInArrow(
        score, "id long, held_out boolean, key long, score double, predicted int")
    return scored.drop("key") if key is None else scored


def keep_civil(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic, all columns as they are. Equal rows share their fate; rows
    without text or id are judged like others; an empty table, or one without labels, loses nothing."""
    scored = score_toxicity(docs, labels, id_col, text_col, key=row_key(docs))
    rejected = staged(scored.where("predicted = 1").select("key").distinct(), "rejected")
    return keyed(docs).join(rejected, "key", "left_anti").select("row.*")
