"""Language identification: averaged hashed subword embeddings with a linear softmax and calibrated rejection.

The n-grams (1 to 3 letters, word edges included) of a text are hashed into
buckets whose embeddings are averaged; a linear softmax gives the languages.
Embeddings and weights are trained jointly by stochastic gradient descent in
numpy on at most ``MOST`` rows with letters of each language; of a text over
``LONGEST`` characters as many are read, in pieces spread over the text (the
documented bound of the sample).  A fifth of the sample is kept
from training and fixes a temperature, by which scores are probabilities, and
the rejection threshold: the smallest score from which on at least
``PRECISION`` of the kept part is right.

Prediction reads whole texts, in blocks, and needs only the text.  The model
(one row of logits a bucket) is of fixed size.

Defined results: a null text or one without letters is ``und`` with score 0;
without any labelled row everything is ``und``; equal scores go to the first
language in code point order.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatio.llm.common import per_text, prepare, put, remainder
from curatio.llm.subword import BITS, MeanSoftmax, bag, excerpt, gram_buckets, has_letters, labelled_sample, letters, softmax

SIZES = (1, 2, 3)
MOST, LONGEST = 400, 20_000
PRECISION = 0.99
UNKNOWN = "und"
BLOCK = 1 << 18


class Model:
    def __init__(self, langs: list[str], table: np.ndarray, heat: float, least: float) -> None:
        self.langs, self.table, self.heat, self.least = langs, table, heat, least


def mean_logits(text: str, table: np.ndarray) -> tuple[np.ndarray, int]:
    """Mean logits of the n-grams of a whole text, and their number."""
    c = letters(text)
    total, n, reach = np.zeros(table.shape[1]), 0, max(SIZES) - 1
    for i in range(0, len(c), BLOCK):
        for size in SIZES:  # grams that start in this block
            b = gram_buckets(c[i : min(i + BLOCK, len(c)) + size - 1], (size,))
            total += table[b].sum(axis=0, dtype=np.float64)
            n += len(b)
    return total / max(1, n), n


def train(rows: list[tuple[str, str]]) -> Model | None:
    """Model of (language, text) rows."""
    langs = sorted({lang for lang, _ in rows}, key=lambda x: x.encode())
    if not langs:
        return None
    rows = sorted(rows, key=lambda r: xxhash.xxh3_64_intdigest(repr(r)))
    bags = [bag(gram_buckets(letters(t), SIZES)) for _, t in rows]
    rows, bags = [r for r, b in zip(rows, bags) if len(b[0])], [b for b in bags if len(b[0])]
    y = np.array([langs.index(lang) for lang, _ in rows], dtype=np.int64)
    hold = np.arange(len(rows)) % 5 == 4
    fit = np.flatnonzero(~hold)
    seen = np.bincount(y[fit], minlength=len(langs))
    weight = (len(fit) / np.maximum(1, seen * len(langs)))[y[fit]].astype(np.float32)
    model = MeanSoftmax(len(langs), BITS).fit([bags[i] for i in fit], np.eye(len(langs), dtype=np.float32)[y[fit]], weight, 8, 0.2)
    table = model.table()
    z = np.array([(table[b] * s[:, None]).sum(axis=0) for (b, s), h in zip(bags, hold) if h])
    if not len(z):
        return Model(langs, table, 1.0, 0.0)
    right = y[hold]
    heats = np.geomspace(0.05, 20, 60)
    loss = [-np.log(softmax(z / t)[np.arange(len(z)), right] + 1e-12).mean() for t in heats]
    heat = float(heats[int(np.argmin(loss))])
    p = softmax(z / heat)
    top, ok = p.max(axis=1), p.argmax(axis=1) == right
    order = np.argsort(-top)
    good = np.cumsum(ok[order]) / np.arange(1, len(order) + 1) >= PRECISION
    least = float(top[order][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return Model(langs, table, heat, least)


def predict(text: bytes | None, model: Model | None) -> tuple[str, float, bool]:
    if text is None or model is None:
        return UNKNOWN, 0.0, True
    z, n = mean_logits(text.decode("utf-8", "replace"), model.table)
    if not n:
        return UNKNOWN, 0.0, True
    p = softmax(z / model.heat)
    k = int(p.argmax())
    return model.langs[k], float(p[k]), bool(p[k] < model.least)


def identify(docs: DataFrame, out: str = "language", *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", most: int = MOST, longest: int = LONGEST) -> DataFrame:
    """``docs`` with the struct ``out``: lang_pred, score, rejected.

    Learned from the rows with a language whose id's remainder is not 2.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(doc_id).alias("i"), F.col(lang).alias("l"), F.col(text).alias("t"))
    rows = rows.where((remainder("i", 4) != 2) & F.col("l").isNotNull() & has_letters(F.col("t")))
    rows = labelled_sample(rows.select("l", excerpt(F.col("t"), longest).alias("t"), F.xxhash64("i").alias("o")), "l", F.struct("o", "t"), most)
    held = spark.sparkContext.broadcast(train([(r["l"], r["t"]) for r in rows.select("l", "t").collect()]))

    def task():
        model = held.value
        return lambda t: predict(t, model)

    return put(docs, out, per_text(task, "lang_pred string, score double, rejected boolean", ["lang_pred", "score", "rejected"])(F.col(text)))
