"""Document fingerprints by consistent weighted sampling, in DataFrame functions alone.

The terms of a text are its lower-case words, the weight S of a term is its count. For every term and sample number a
hash gives r and c from the gamma law of shape 2 and b from the uniform law. With ``t = floor(ln S / r + b)`` the term
has the value ``ln a = ln c - r (t - b + 1)``; the term with the smallest value, together with t, is the sample. Two
texts have the same sample with a probability that equals their generalised Jaccard similarity (sum of the smaller
weights over sum of the larger ones). The share of equal samples estimates it.

The gamma law is read from a table of its quantiles at ``QUANTILES`` mid-points: equal for all texts, so samples stay
consistent. A fingerprint holds 16 bits of each of ``SAMPLES`` samples.

Work of one text stays in its row until its terms are exploded and reduced to one row again in the same task; the
texts are shuffled once, in ranges of ids, which also puts a document beside its follower.

Defined results: null text is an empty text; equal texts, also empty ones, have equal fingerprints (likeness 1), an
empty and another text likeness 0. Rows without id come last; equal ids are ordered by text; repeated rows follow each
other; the only document follows itself; an empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantflow.llm.common import GAP, pick

SAMPLES = 64
GROUP = 8  # samples taken side by side; more would make methods too large for the just-in-time compiler
QUANTILES = 1024
BITS = 20
BUCKETS_PER_PARTITION = 4


def gamma_quantile(u: float) -> float:
    """x with 1 - (1 + x) exp(-x) = u, by bisection and Newton steps."""
    low, high = 0.0, 60.0
    for _ in range(12):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - (1 + mid) * math.exp(-mid) < u else (low, mid)
    x = (low + high) / 2
    for _ in range(6):
        x -= (1 - (1 + x) * math.exp(-x) - u) / (x * math.exp(-x))
    return x


def _literal(values: list[int]) -> Column:
    # an array of the numbers as one node that all samples share; a list would become a node for each number
    return F.lit(np.array(values))


def term_weights(text: Column) -> Column:
    """Array of (term hash, weight) of a text's words, without a shuffle: sort, then lengths of equal runs."""
    words = F.filter(F.split(F.lower(text), GAP), lambda w: w != "")
    hashed = F.sort_array(F.transform(words, lambda w: F.xxhash64(w)))
    # hashed is bound once; starts of runs, then the distance to the next start
    runs = F.transform(
        F.array(hashed),
        lambda s: F.struct(s.alias("s"), F.filter(
            F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1))).alias("at")),
    )
    weights = F.transform(
        runs,
        lambda r: F.transform(r["at"], lambda p, i: F.struct(
            F.get(r["s"], p).alias("term"),
            (F.coalesce(F.get(r["at"], i + 1), F.size(r["s"])) - p).alias("weight"))),
    )
    return F.when(F.size(words) > 0, F.get(weights, F.lit(0)))


def samples(term: Column, log_weight: Column, group: Column, count: int = GROUP) -> list[Column]:
    """Per sample number of ``group`` a long whose order is that of ln a and whose low 31 bits name term and t.

    Fixed-point numbers with ``BITS`` binary digits; ``log_weight`` is ln S in that form.
    """
    one = 1 << BITS
    gamma = [gamma_quantile((i + 0.5) / QUANTILES) for i in range(QUANTILES)]
    # r and 1 / r share a number
    r_of = _literal([(round(g * one) << 32) + round(one / g) for g in gamma])
    ln_c_of = _literal([round(math.log(g) * one) for g in gamma])
    out = []
    for j in range(count):
        h = F.xxhash64(term, group * count + j)
        both = F.get(r_of, h.bitwiseAND(QUANTILES - 1).cast("int"))
        r, inverse = F.shiftright(both, 32), both.bitwiseAND((1 << 32) - 1)
        ln_c = F.get(ln_c_of, F.shiftright(h, 10).bitwiseAND(QUANTILES - 1).cast("int"))
        b = F.shiftright(h, 20).bitwiseAND(one - 1)
        t = F.shiftright(F.shiftright(log_weight * inverse, BITS) + b, BITS)
        ln_a = ln_c - F.shiftright(r * (F.shiftleft(t, BITS) - b + one), BITS)
        name = (F.shiftright(h, 3) + t * 2654435761).bitwiseAND((1 << 31) - 1)
        out.append(F.shiftleft(ln_a, 31).bitwiseOR(name))
    return out


def likeness(a: Column, b: Column, count: int = SAMPLES) -> Column:
    """Share of equal samples of two arrays."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return same / F.lit(float(count))


def _in_range(docs: DataFrame) -> tuple[DataFrame, int]:
    """``docs`` with a ``bucket`` by range of ids; rows without id are in bucket -1. The bounds are some hundred numbers."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = partitions * BUCKETS_PER_PARTITION
    cuts = [i / n for i in range(1, n)]
    bounds = docs.agg(F.percentile_approx("id", cuts, 100 * n)).first()[0] or []
    bounds = sorted(set(bounds))
    if not bounds:
        return docs.withColumn("bucket", F.when(F.col("id").isNull(), -1).otherwise(0)), n
    table = F.from_json(F.lit(json.dumps(bounds)), "array<bigint>")
    at = F.size(F.filter(table, lambda b: b < F.col("id")))
    return docs.withColumn("bucket", F.when(F.col("id").isNull(), -1).otherwise(at)), n


def followed(docs: DataFrame) -> DataFrame:
    """``id, text`` in descending order of ids, dealt into ``bucket`` with position ``rn``; each bucket ends with a
    copy (``extra``) of the row that follows its last one, the first row of all after the last."""
    ranged, _ = _in_range(docs)
    heads = ranged.groupBy("bucket").agg(F.max("id").alias("head"))
    # one row for each bucket: their number is bounded
    order = Window.orderBy(F.desc("bucket"))
    heads = heads.select(
        "head", "bucket", F.lead("bucket", -1).over(order).alias("before"),
        F.max("bucket").over(Window.partitionBy()).alias("top"), F.min("bucket").over(Window.partitionBy()).alias("low"),
    ).select("head", F.col("bucket").alias("own"), F.when(F.col("bucket") == F.col("top"), F.col("low")).otherwise(
        F.col("before")).alias("bucket"))
    extra = (
        ranged.withColumnRenamed("bucket", "own")
        .join(heads, ["own"]).where(F.col("id").eqNullSafe(F.col("head")))
        .groupBy("bucket").agg(F.min("text").alias("text"))
        .select(F.lit(None).cast("long").alias("id"), "text", "bucket", F.lit(1).alias("extra"))
    )
    within = Window.partitionBy("bucket").orderBy("extra", F.desc_nulls_last("id"), "text")
    return (
        ranged.withColumn("extra", F.lit(0)).unionByName(extra)
        .withColumn("rn", F.row_number().over(within)).withColumn("next", F.lead("text").over(within))
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count: int = SAMPLES) -> DataFrame:
    """``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` per row."""
    rows = pick(docs, id_col, text_col).toDF("id", "text").select(
        F.col("id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    n_chars = F.length("text")
    third = F.floor(n_chars / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n_chars - third), F.substring("next", F.lit(1), third))

    def version(kind: int, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("t"))

    plain = version(0, F.col("text"))
    versions = F.when(F.col("extra") == 1, F.array(plain)).otherwise(F.array(plain, version(1, edited)))
    texts = (
        followed(rows).select("bucket", "rn", "id", "extra", n_chars.cast("long").alias("n_chars"), F.explode(versions).alias("v"))
        .select(
            "bucket", "rn", "id", "extra", "n_chars", F.col("v.kind").alias("kind"),
            F.when(F.col("v.kind") == 1, F.sha2(F.encode("v.t", "UTF-8"), 256)).alias("sha"),
            term_weights(F.col("v.t")).alias("terms"),
        )
    )
    keys = ["bucket", "rn", "kind", "extra", "id", "n_chars", "sha"]
    terms = texts.select(*keys, F.explode_outer("terms").alias("x")).select(
        *keys, F.col("x.term").alias("term"), (F.log(F.col("x.weight")) * (1 << BITS)).cast("long").alias("ln_s"),
        F.explode(F.sequence(F.lit(0), F.lit(count // GROUP - 1))).alias("part"),
    )
    mins = [F.min(s).alias(f"s{j}") for j, s in enumerate(samples(F.col("term"), F.col("ln_s"), F.col("part")))]
    # both aggregations find all rows of a key in their task
    parts = terms.groupBy(*keys, "part").agg(*mins).select(*keys, "part", F.array(
        *[F.coalesce(F.col(f"s{j}").bitwiseAND(0xFFFF), F.lit(-1)).cast("int") for j in range(GROUP)]).alias("mins"))
    sketch = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("part", "mins"))).alias("sig")).select(
        *keys, F.flatten(F.col("sig.mins")).alias("sig"))
    beside = Window.partitionBy("bucket").orderBy("rn", "kind")
    both = sketch.select(
        "*", F.lead("sha").over(beside).alias("edited_sha256"), F.lead("sig").over(beside).alias("edited_sig"),
        F.lead("sig", 2).over(beside).alias("next_sig"),
    ).where((F.col("kind") == 0) & (F.col("extra") == 0))

    def text_of(sig: str) -> Column:
        return F.array_join(F.transform(sig, lambda x: F.when(x < 0, "----").otherwise(F.lpad(F.lower(F.hex(x)), 4, "0"))), "")

    return both.select(
        "id", "n_chars", "edited_sha256", text_of("sig").alias("fingerprint"), text_of("edited_sig").alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig"), count).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig"), count).alias("near_next"),
    )
