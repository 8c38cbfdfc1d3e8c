"""Hashed subword bags: n-grams of letters inside words, and a mean-embedding linear softmax in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatio.llm.common import fresh, mix

BITS = 15
_ALPHA: list[np.ndarray] = []
_PRIME = np.uint64(0x100000001B3)


def alpha() -> np.ndarray:
    """For each code point, whether it is a letter."""
    if not _ALPHA:
        _ALPHA.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _ALPHA[0]


def letters(text: str) -> np.ndarray:
    """Lower-cased code points with every non-letter as 0, framed by 0."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    out = np.zeros(len(c) + 2, dtype=np.uint64)
    out[1:-1] = np.where(alpha()[c.astype(np.int64)], c, 0)
    return out


def word_grams(c: np.ndarray, n: int, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams inside words, and the place of a letter of each; a word's edge counts as a letter."""
    m = len(c) - n + 1
    if m < 1:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    h = np.full(m, n, dtype=np.uint64)
    inside = np.ones(m, dtype=bool)
    for j in range(n):
        h = h * _PRIME + c[j : j + m]
        if 0 < j < n - 1 or n == 1:
            inside &= c[j : j + m] > 0
    if n == 2:
        inside &= (c[:m] > 0) | (c[1:] > 0)
    at = np.flatnonzero(inside)
    return (mix(h[at]) >> np.uint64(64 - bits)).astype(np.int64), at + (1 if n > 2 else 0)


def gram_buckets(c: np.ndarray, sizes: tuple[int, ...], bits: int = BITS) -> np.ndarray:
    """Buckets of the n-grams of all sizes."""
    return np.concatenate([word_grams(c, n, bits)[0] for n in sizes])


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def excerpt(text: Column, longest: int, pieces: int = 8) -> Column:
    """A text of up to ``longest`` characters as it is; of a longer one as many, in pieces spread from its begin to its end."""
    part = longest // pieces
    begin = lambda k: (F.lit(1) + F.floor(k * (F.length(text) - part) / (pieces - 1))).cast("int")
    spread = F.concat_ws(" ", *[F.substring(text, begin(F.lit(k).cast("long")), F.lit(part)) for k in range(pieces)])
    return F.when(F.length(text) <= longest, text).otherwise(spread)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class MeanSoftmax:
    """softmax(mean of bucket embeddings @ weights + bias), trained jointly by adaptive stochastic gradient descent."""

    def __init__(self, classes: int, bits: int = BITS, dim: int = 16, seed: int = 1) -> None:
        rng = np.random.default_rng(seed)
        # embeddings start at 0, so that buckets without training add nothing
        self.emb = np.zeros((1 << bits, dim), dtype=np.float32)
        self.out = (rng.standard_normal((dim, classes)) / np.sqrt(dim)).astype(np.float32)
        self.bias = np.zeros(classes, dtype=np.float32)

    def fit(self, bags: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, weight: np.ndarray, epochs: int, rate: float, batch: int = 32, seed: int = 2) -> MeanSoftmax:
        """``bags``: (buckets, shares that add up to 1) of each example; ``target``: class probabilities."""
        rng = np.random.default_rng(seed)
        weight = weight / weight.mean()
        seen_emb = np.full(len(self.emb), 1e-8, dtype=np.float32)
        seen_out, seen_bias = np.full_like(self.out, 1e-8), np.full_like(self.bias, 1e-8)
        size = np.array([len(b[0]) for b in bags])
        for _ in range(epochs):
            order = rng.permutation(len(bags))
            for i in range(0, len(order), batch):
                pick = order[i : i + batch]
                idx, back = np.unique(np.concatenate([bags[k][0] for k in pick]), return_inverse=True)
                share = np.concatenate([bags[k][1] for k in pick]).astype(np.float32)
                row = np.repeat(np.arange(len(pick)), size[pick])
                mean = np.zeros((len(pick), len(idx)), dtype=np.float32)
                mean[row, back] = share
                x = mean @ self.emb[idx]
                g = (softmax(x @ self.out + self.bias) - target[pick]) * weight[pick, None] / len(pick)
                d_emb, d_out, d_bias = mean.T @ (g @ self.out.T), x.T @ g, g.sum(axis=0)
                # steps shrink with the squared gradients that a parameter has seen
                seen_emb[idx] += (d_emb**2).mean(axis=1)
                seen_out += d_out**2
                seen_bias += d_bias**2
                self.emb[idx] -= rate * d_emb / np.sqrt(seen_emb[idx])[:, None]
                self.out -= rate * d_out / np.sqrt(seen_out)
                self.bias -= rate * d_bias / np.sqrt(seen_bias)
        return self

    def table(self) -> np.ndarray:
        """What each bucket adds to the logits of a bag's mean; the bias is inside, as shares add up to 1."""
        return (self.emb @ self.out + self.bias).astype(np.float32)


def bag(buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    idx, n = np.unique(buckets, return_counts=True)
    return idx, n / max(1, n.sum())


def labelled_sample(rows: DataFrame, label: str, order: Column, most: int) -> DataFrame:
    """At most ``most`` rows of each label, the first by ``order``; a limit inside each task comes before the shuffle."""
    rank = fresh(rows, "__rank")
    w = Window.partitionBy(label).orderBy(order)
    return rows.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= most).drop(rank)
