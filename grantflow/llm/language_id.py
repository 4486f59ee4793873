"""Language identification: a bidirectional gated recurrent network over UTF-8 bytes.

Every byte position gets a probability for each language; a document's probabilities are their mean over all
positions. Texts are read whole, in windows of ``WINDOW`` bytes that overlap by ``CONTEXT`` bytes on either side, so
that each labelled position has seen its surroundings.

Training: at most ``PER_LANG`` documents of a language, chosen by a hash of the id, and of each at most ``CROP``
characters; the bound doesn't grow with the corpus. The model goes to executors with the task (a few kB).

Defined results: null text or text without a letter gives ``und`` with score 0; without any labelled text every row
is ``und``; rows without id are scored and count as not held out; repeated rows give repeated rows; an empty table
gives an empty table; further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from grantflow.llm.common import pick, small
from grantflow.llm.recurrent import Adam, Gru, both_ways, flip, table_gradient, uniform, unflip

PER_LANG = 250
CROP = 2000
WINDOW = 256
CONTEXT = 8
SIZE = 8
PAD = 256
LETTER = re.compile(r"[^\W\d_]")


class Model(NamedTuple):
    langs: list[str]
    params: dict[str, np.ndarray]


def probabilities(h: np.ndarray, p: dict[str, np.ndarray]) -> np.ndarray:
    """Of each language at each position: [time, langs, batch]."""
    logits = p["w"] @ h
    logits += p["b"][:, None]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def train(texts: list[str], labels: list[str], steps: int = 300, length: int = 64, batch: int = 128) -> Model:
    langs = sorted(set(labels))
    rng = np.random.default_rng(7)
    k = len(langs)
    p = {
        "table": uniform(rng, 2, PAD + 1, 3 * SIZE, scale=0.5), "u": uniform(rng, 2, 3 * SIZE, SIZE, scale=0.35),
        "w": uniform(rng, k, 2 * SIZE, scale=0.3), "b": np.zeros(k, dtype=np.float32),
    }
    by_lang = [[np.frombuffer(t.encode("utf-8", "replace"), np.uint8) for t, x in zip(texts, labels, strict=True)
                if x == lang and t] for lang in langs]
    by_lang = [x or [np.zeros(0, np.uint8)] for x in by_lang]
    adam = Adam(p, 0.02)
    for step in range(steps):
        adam.rate = 0.02 * (1 - step / steps) + 0.001
        target = rng.integers(k, size=batch)
        x = np.full((length, batch), PAD, dtype=np.int64)
        for j, y in enumerate(target):
            text = by_lang[y][rng.integers(len(by_lang[y]))]
            start = rng.integers(max(1, len(text) - length // 2))
            part = text[start : start + length]
            x[: len(part), j] = part
        h, kept = Gru.forward(both_ways(x, p["table"]), p["u"], keep=True)
        h = flip(h)
        d = probabilities(h, p)
        d[:, target, np.arange(batch)] -= 1
        d *= ((x != PAD) / np.float32(max(1, int((x != PAD).sum()))))[:, None, :].astype(np.float32)
        d_gx, d_u = Gru.backward(unflip(p["w"].T @ d), p["u"], kept)
        adam.update({
            "table": table_gradient(x, d_gx, PAD + 1), "u": d_u, "b": d.sum(axis=(0, 2)),
            "w": np.einsum("tkb,thb->kh", d, h, optimize=True),
        })
    return Model(langs, p)


def windows(data: np.ndarray) -> list[tuple[int, int, int, int]]:
    """``(from, to, first labelled, after last labelled)``: every position is labelled once."""
    core = WINDOW - 2 * CONTEXT
    if len(data) <= WINDOW:
        return [(0, len(data), 0, len(data))]
    return [
        (max(0, s - CONTEXT), min(len(data), s + core + CONTEXT), s, min(len(data), s + core))
        for s in range(0, len(data), core)
    ]


def document_probabilities(texts: list[str], model: Model, batch: int = 512) -> np.ndarray:
    """Mean probabilities over all byte positions of each text; zeros for an empty text."""
    data = [np.frombuffer(t.encode("utf-8", "replace"), np.uint8) for t in texts]
    todo = [(i, *w) for i, d in enumerate(data) for w in windows(d) if len(d)]
    todo.sort(key=lambda w: w[2] - w[1])
    sums = np.zeros((len(texts), len(model.langs)))
    for at in range(0, len(todo), batch):
        part = todo[at : at + batch]
        longest = part[-1][2] - part[-1][1]
        x = np.full((len(part), longest), PAD, dtype=np.int64)
        mask = np.zeros((len(part), longest), dtype=np.float32)
        for j, (i, start, end, first, last) in enumerate(part):
            x[j, : end - start] = data[i][start:end]
            mask[j, first - start : last - start] = 1
        x = np.ascontiguousarray(x.T)
        h, _ = Gru.forward(both_ways(x, model.params["table"]), model.params["u"])
        labelled = np.einsum("tkb,bt->bk", probabilities(flip(h), model.params), mask, optimize=True)
        np.add.at(sums, [w[0] for w in part], labelled)
    return sums / np.maximum(1, [[len(d)] for d in data])


def training_sample(docs: DataFrame, usable: Column) -> DataFrame:
    """At most PER_LANG rows of each language, the same ones whatever the partitions; kept small before any shuffle."""
    order = F.xxhash64("id")
    first = Window.partitionBy("lang").orderBy(order, "text")
    start = F.pmod(order, F.greatest(F.length("text") - CROP, F.lit(0)) + 1).cast("int") + 1
    return (
        docs.where(usable & F.col("lang").isNotNull() & (F.length("text") > 0))
        .select("lang", "id", F.substring("text", start, F.lit(CROP)).alias("text"))
        .withColumn("n", F.row_number().over(first)).where(F.col("n") <= PER_LANG).select("lang", "text", "n")
    )


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    held_out: Column | None = None,
) -> DataFrame:
    """``id, held_out, lang_pred, score`` per row; learns only from rows that are not ``held_out`` (a condition on ``id``)."""
    rows = pick(docs, id_col, text_col, lang_col).toDF("id", "text", "lang")
    held_out = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    sample = sorted(map(tuple, training_sample(rows, ~held_out).collect()))
    model = train([r[1] for r in sample], [r[0] for r in sample]) if sample else None
    schema = pa.schema([
        ("id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            texts = [t if LETTER.search(t) else "" for t in texts]
            if model is None:
                names, scores = ["und"] * len(texts), [0.0] * len(texts)
            else:
                pooled = document_probabilities(texts, model)
                names = [model.langs[k] if t else "und" for t, k in zip(texts, pooled.argmax(axis=1), strict=True)]
                scores = np.minimum(pooled.max(axis=1), 1.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array(names), pa.array(scores, pa.float64())],
                schema=schema)

    return rows.select(F.col("id").cast("long").alias("id"), held_out.alias("held_out"), "text").mapInArrow(
        score, from_arrow_schema(schema))
