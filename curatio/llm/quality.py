"""Quality classifier: weak labellers, a label model fitted by expectation-maximisation, a hashed linear scorer.

Labellers look at measurements of a whole text and vote good (1), bad (-1) or
abstain (0), which counts for neither.  The label model has a prior and, for
each labeller, the probability of its votes given the true class; expectation-maximisation fits
them to the counts of vote patterns over all documents (at most 3 to the
number of labellers, however many documents there are).  The patterns'
posteriors are soft labels for a linear scorer on hashed token shapes and
binned measurements, trained by logistic regression in numpy on at most
``MOST`` documents of each vote sum (the documented bound of the sample).
The scorer judges every document: it is kept if its score is 0.5 or more.

Defined results: a null text, or one without words, is not judged bad by the
measurements it lacks; it has score 0 and is rejected as empty; repeated
documents are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from operator import and_, eq

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatio.llm.common import durable, per_text, prepare, put
from curatio.llm.subword import labelled_sample

BITS = 12
MOST = 250
EPOCHS, RATE = 12, 0.1
SCHEMA = "votes array<int>, idx array<int>, val array<float>"
FIELDS = ["votes", "idx", "val"]
MEASURES = ["words", "marks", "capitals", "distinct", "most_common", "doubled", "pairs", "runs", "bars", "framed", "lengths"]
#: (measure, bad from, good up to); NaN abstains.  Fixed values of the heuristics.
LABELLERS = [
    ("marks", 0.20, 0.08),        # share of characters that are neither letters, digits nor space
    ("capitals", 0.45, 0.12),     # share of letters in upper case
    ("most_common", 0.25, 0.12),  # share of the most frequent word, from 20 words on
    ("doubled", 0.20, 0.03),      # share of words that repeat the one before
    ("bars", 0.15, 0.01),         # share of words that are only marks
    ("framed", 0.35, 0.20),       # share of words with two or more marks at the end
    ("pairs", -0.55, -0.80),      # distinct pairs of neighbouring words by pairs, sign reversed
    ("runs", 0.15, 0.02),         # share of words that stand between two of their like
    ("distinct", -0.12, -0.30),   # distinct words by words, sign reversed, up to 1000 words
]
# Bytes as classes: letters and bytes of other scripts x, capitals X, digits 9, spaces; other marks as they are.
SHAPE = bytes(
    120 if 97 <= b <= 122 or b >= 128 else 88 if 65 <= b <= 90 else 57 if 48 <= b <= 57 else b for b in range(256)
)
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def measure(text: bytes, words: list[bytes]) -> dict[str, float]:
    n = len(words)
    shape = text.translate(SHAPE)
    chars = len(text)
    low, up, num = shape.count(b"x"), shape.count(b"X"), shape.count(b"9")
    space = sum(shape.count(c) for c in (b" ", b"\n", b"\t", b"\r"))
    nan = float("nan")
    count = Counter(words)
    many = n >= 20
    same = list(map(eq, words, words[1:]))
    return {
        "words": n,
        "marks": (chars - low - up - num - space) / max(1, chars),
        "capitals": up / max(1, low + up),
        "distinct": -len(count) / n if many and n <= 1000 else nan,
        "most_common": max(count.values()) / n if many else nan,
        "doubled": sum(same) / n if many else nan,
        "pairs": -len(set(zip(words, words[1:]))) / (n - 1) if many else nan,
        "runs": sum(map(and_, same, same[1:])) / n if many else nan,
        "bars": sum(k for w, k in count.items() if not w.strip(_MARKS)) / n,
        "framed": sum(k for w, k in count.items() if len(w) - len(w.rstrip(_MARKS)) >= 2) / n,
        "lengths": sum(map(len, words)) / n,
    }


def votes(m: dict[str, float]) -> list[int]:
    out = []
    for name, bad, good in LABELLERS:
        x = m[name]
        out.append(0 if x != x else -1 if x >= bad else 1 if x <= good else 0)
    return out


def features(words: list[bytes], m: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed shares of token shapes and shape pairs, and binned measurements."""
    line = np.frombuffer(b" ".join(words).translate(SHAPE), dtype=np.uint8)
    # of a run of one shape one is left
    shapes = [s[:12] for s in line[np.concatenate(([True], line[1:] != line[:-1]))].tobytes().split(b" ")]
    n = len(shapes)
    share: dict[int, float] = {}
    same = sum(map(eq, words, words[1:]))
    repeats = {k: c for k, c in ((b"=", same), (b"/", n - 1 - same)) if c}
    for kind, counted in ((b"1", Counter(shapes)), (b"2", Counter(zip(shapes, shapes[1:]))), (b"3", repeats)):
        for s, c in counted.items():
            key = kind + (b" ".join(s) if isinstance(s, tuple) else s)
            k = xxhash.xxh3_64_intdigest(key) >> (64 - BITS)
            share[k] = share.get(k, 0.0) + c / n
    for name in MEASURES:
        x = m[name]
        step = "none" if x != x else int(np.log2(1 + x)) if name in ("words", "lengths") else int(abs(x) * 20)
        k = xxhash.xxh3_64_intdigest(f"{name}:{step}".encode()) >> (64 - BITS)
        share[k] = share.get(k, 0.0) + 1.0
    idx = np.array(sorted(share), dtype=np.int32)
    return idx, np.array([share[k] for k in idx.tolist()], dtype=np.float32)


def vote(text: bytes | None) -> tuple:
    words = (text or b"").split()
    return (votes(measure(text, words)) if words else None,)


def read(text: bytes | None) -> tuple:
    words = (text or b"").split()
    if not words:
        return None, None, None
    m = measure(text, words)
    return votes(m), *features(words, m)


class LabelModel:
    """Prior of good and P(vote | class) of each labeller, by expectation-maximisation over pattern counts."""

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200) -> None:
        p = np.array([v for v, _ in patterns], dtype=np.int64) + 1
        n = np.array([c for _, c in patterns], dtype=np.float64)
        self.patterns = [v for v, _ in patterns]
        # one bad vote weighs more than one good: heuristics fire on faults
        good = 1 / (1 + np.exp(3.0 * (p == 0).sum(axis=1) - 0.5 * (p == 2).sum(axis=1)))
        for _ in range(rounds):
            before = good
            self.prior = (good @ n + 1) / (n.sum() + 2)
            cond = np.empty((2, p.shape[1], 3))
            for cls, w in enumerate(((1 - good) * n, good * n)):
                for v in range(3):
                    cond[cls, :, v] = (w @ (p == v) + 0.5) / (w @ (p != 1) + 1.0)
            self.cond = cond
            z = np.log(self.prior / (1 - self.prior))
            lift = np.log(cond[1] / cond[0])
            lift[:, 1] = 0.0  # to abstain says nothing
            z = z + lift[np.arange(p.shape[1])[None, :], p].sum(axis=1)
            good = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            if np.abs(good - before).max() < 1e-6:
                break
        self.good = dict(zip(self.patterns, good.tolist()))

    def accuracies(self) -> list[float]:
        """Probability that a labeller that votes is right."""
        c, q = self.cond, self.prior
        right = q * c[1, :, 2] + (1 - q) * c[0, :, 0]
        return (right / np.maximum(1e-12, q * (c[1, :, 0] + c[1, :, 2]) + (1 - q) * (c[0, :, 0] + c[0, :, 2]))).tolist()


def fit(bags: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> np.ndarray:
    """Weights of the scorer (bias last), by adaptive stochastic gradient descent."""
    w, seen = np.zeros((1 << BITS) + 1), np.full((1 << BITS) + 1, 1e-8)
    rng = np.random.default_rng(3)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(bags)):
            idx, val = bags[k]
            g = 1 / (1 + np.exp(-np.clip(w[idx] @ val + w[-1], -30, 30))) - y[k]
            at, d = np.append(idx, -1), np.append(g * val, g)
            d = d + 1e-4 * w[at]
            seen[at] += d * d
            w[at] -= RATE * d / np.sqrt(seen[at])
    return w


def classify(docs: DataFrame, out: str = "quality", *, text: str = "text", most: int = MOST) -> DataFrame:
    """``docs`` with the struct ``out``: votes, score, keep."""
    spark = docs.sparkSession
    prepare(spark)
    cast = per_text(lambda: vote, "votes array<int>", ["votes"])
    seen = docs.select(F.xxhash64(text).alias("o"), cast(F.col(text))["votes"].alias("votes")).where("votes IS NOT NULL")
    seen = durable(seen.groupBy("o").agg(F.first("votes").alias("votes"), F.count(F.lit(1)).alias("n")))
    counts = [(tuple(r["votes"]), r["n"]) for r in seen.groupBy("votes").agg(F.sum("n").alias("n")).collect()]
    weights = None
    if counts:
        model = LabelModel(sorted(counts))
        total = F.aggregate("votes", F.lit(0), lambda a, v: a + v)
        # at most ``most`` texts of each of the few vote sums, by hash; copies count once
        few = labelled_sample(seen.select("o", total.alias("sum")), "sum", F.col("o"), most).select("o")
        texts = docs.select(F.xxhash64(text).alias("o"), F.col(text).alias("t")).join(F.broadcast(few), "o")
        rows = texts.groupBy("o").agg(F.min("t").alias("t")).select("o", per_text(lambda: read, SCHEMA, FIELDS)(F.col("t")).alias("r"))
        rows = sorted(((r["o"], tuple(r["votes"]), r["idx"], r["val"]) for r in rows.select("o", "r.*").collect()), key=lambda r: r[0])
        bags = [(np.array(i, dtype=np.int64), np.array(v)) for _, _, i, v in rows]
        weights = fit(bags, np.array([model.good[v] for _, v, _, _ in rows]))
    held = spark.sparkContext.broadcast(weights)

    def task():
        w = held.value

        def one(t):
            v, idx, val = read(t)
            if v is None or w is None:
                return None, 0.0
            return v, float(1 / (1 + np.exp(-np.clip(w[idx] @ val + w[-1], -30, 30))))

        return one

    d = put(docs, out, per_text(task, "votes array<int>, score double", ["votes", "score"])(F.col(text)))
    return put(d, out, F.struct(F.col(out)["votes"].alias("votes"), F.col(out)["score"].alias("score"), (F.col(out)["score"] >= 0.5).alias("keep")))
