"""Toxicity: subword-bag embeddings averaged into a linear softmax, word by word.

Each word (a run of letters) is a bag of its hashed n-grams (3 to 5 letters,
word edges included).  The bag's mean embedding goes through a linear softmax; both
are trained jointly in numpy, so an unseen misspelling shares the vectors of
the n-grams it has in common with known words.  Labels mark documents, not
words: all words of clean documents are clean, and words that occur in toxic
documents more often than chance allows are toxic, first in all documents, then
in those that hold none of the words found; in a second round also those that the
model itself takes for toxic in toxic documents without such a word.
A document's score is the softmax of its two most toxic words' logits, with
temperature and prior fitted on a part of the sample that the words were
not trained on.

The sample has at most ``MOST`` labelled ids of each label, drawn among those
whose text has letters; of a text over ``LONGEST`` characters it reads as many,
in pieces spread over the text (the documented bound).  Only the drawn ids are
broadcast; texts stay where they are.  Scores read whole texts.

Defined results: an empty or null text has the score of a document without
toxic words; without labels of both kinds every score is 0; an id that is
labelled both toxic and clean is not learned from; of rows that share a drawn id
one text is read, the smallest.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatio.llm.common import durable, per_text, prepare, put, remainder
from curatio.llm.subword import MeanSoftmax, excerpt, has_letters, labelled_sample, letters, word_grams

SIZES = (3, 4, 5)
MOST, LONGEST = 700, 6_000
ROUNDS, STEPS, BATCH, RATE = 2, 160, 256, 0.1
BITS = 18
STRAY = 0.05  # share of clean documents a toxic word may be in, to that of toxic ones
FLOOR = -12.0  # logit of a missing word
BLOCK = 1 << 18
DDL = "score double, words array<string>"


def logits(c: np.ndarray, diff: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Toxic minus clean logit of each word of framed letters, and where it begins and ends."""
    on = (c > 0).astype(np.int8)
    edge = np.diff(on)
    begin, end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    total, n = np.zeros(len(begin)), np.zeros(len(begin))
    word = np.cumsum(np.concatenate(([0], edge == 1))) - 1
    for size in SIZES:
        bucket, at = word_grams(c, size, BITS)
        w = word[at]
        total += np.bincount(w, weights=diff[bucket], minlength=len(begin))
        n += np.bincount(w, minlength=len(begin))
    return total / np.maximum(n, 1), begin, end


def text_logits(text: str, diff: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """The two highest word logits of a whole text, and its words above 0 (at most 100)."""
    c = letters(text)
    gaps = np.flatnonzero(c == 0)
    best, words, i = np.array([FLOOR, FLOOR]), set(), 0
    while i < len(c) - 1:
        stop = min(i + BLOCK, len(c) - 1)
        stop = int(gaps[np.searchsorted(gaps, stop)])  # blocks end at the next gap between words
        part = c[i : stop + 1]
        z, begin, end = logits(part, diff)
        best = top_two(np.concatenate([z, best]))
        for k in np.flatnonzero(z > 0)[:100]:
            words.add("".join(map(chr, part[begin[k] : end[k]].tolist())))
        i = stop
    return best, sorted(words)[:100]


def vocabulary(text: str) -> list[str]:
    c = letters(text).tolist()
    return list(dict.fromkeys("".join(chr(x) if x else " " for x in c).split()))


def top_two(z: np.ndarray) -> np.ndarray:
    return np.sort(np.concatenate([z, [FLOOR, FLOOR]]))[-2:].clip(FLOOR, -FLOOR)


def bags(words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and shares of each word's n-grams."""
    c = letters(" ".join(words))
    word = np.cumsum(np.concatenate(([0], np.diff((c > 0).astype(np.int8)) == 1))) - 1
    keys = []
    for size in SIZES:
        bucket, at = word_grams(c, size, BITS)
        keys.append(word[at] << BITS | bucket)
    key, n = np.unique(np.concatenate(keys), return_counts=True)
    end = np.searchsorted(key, np.arange(len(words) + 1) << BITS)
    return [(key[i:j] & (1 << BITS) - 1, n[i:j] / max(1, n[i:j].sum())) for i, j in zip(end[:-1], end[1:])]


def telling(docs: list[tuple[int, list[str]]]) -> tuple[Counter, Counter]:
    """Words that occur in toxic documents too often for chance, with their counts, and the words of clean ones.

    If labels said nothing about words, a word of n documents would be in toxic
    ones only with a chance of the toxic share to the power n; a word counts
    if less than one of all words was to be expected to do as well.
    """
    bad, good = Counter(), Counter()
    for y, words in docs:
        (bad if y else good).update(words)
    toxic = sum(y for y, _ in docs)
    share, clean = toxic / len(docs), len(docs) - toxic
    if not 0 < toxic < len(docs):
        return Counter(), good
    several = sum(n + good[w] >= 3 for w, n in bad.items()) + sum(n >= 3 and w not in bad for w, n in good.items())
    least = max(2, np.log(max(2, several)) / -np.log(share))
    found = {w: n for w, n in bad.items() if n - 3 * good[w] >= least and good[w] * toxic <= STRAY * n * clean}
    return Counter(found), good


def train_words(docs: list[tuple[int, list[str]]]) -> np.ndarray:
    """What each bucket adds to a word's logit, from (label, distinct words) documents."""
    toxic, good = telling(docs)
    while True:  # among the toxic documents that are left, rarer words tell
        rest = [(y, words) for y, words in docs if not y or not any(w in toxic for w in words)]
        more, _ = telling(rest)
        if not more:
            break
        toxic.update(more)
    diff = np.full(1 << BITS, FLOOR)
    for _ in range(ROUNDS):
        if not toxic:
            break
        clean = [w for w in good if w not in toxic]
        rng = np.random.default_rng(5)
        # as many examples of either kind at every size of the sample, drawn by how many documents hold a word
        names, n = list(toxic), STEPS * BATCH
        up, down = np.array([min(50, toxic[w]) for w in names]), np.array([min(4, good[w]) for w in clean])
        pick = [names[i] for i in rng.choice(len(names), n // 5, p=up / up.sum())]
        pick += [clean[i] for i in rng.choice(len(clean), n - n // 5, p=down / down.sum())] if clean else []
        some = sorted(set(pick))
        of = dict(zip(some, bags(some)))
        target = np.array([[0, 1]] * (n // 5) + [[1, 0]] * (len(pick) - n // 5), dtype=np.float32)
        t = MeanSoftmax(2, BITS, 12).fit([of[w] for w in pick], target, np.ones(len(pick), dtype=np.float32), 1, RATE, BATCH).table()
        diff = (t[:, 1] - t[:, 0]).astype(np.float64)
        # toxic documents without such a word: what the model takes for one
        rest = sorted({w for y, words in docs if y and not any(w in toxic for w in words) for w in words if not good[w]})
        fresh_words = [w for w, (b, share) in zip(rest, bags(rest) if rest else []) if (diff[b] * share).sum() > 0]
        if not fresh_words:
            break
        toxic.update({w: 2 for w in fresh_words})
    return diff


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-2) -> np.ndarray:
    """Weights (and bias, last) of a logistic regression, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + l2 * np.eye(len(w))
        w -= np.linalg.solve(h, x.T @ (p - y) + l2 * w)
    return w


class Model:
    def __init__(self, diff: np.ndarray, weights: np.ndarray) -> None:
        self.diff, self.weights = diff, weights

    def score(self, text: str) -> tuple[float, list[str]]:
        best, words = text_logits(text, self.diff)
        return float(1 / (1 + np.exp(-np.clip(np.append(best, 1.0) @ self.weights, -30, 30)))), words


def train(rows: list[tuple[int, str]], share: float = 0.5) -> Model | None:
    """Model of (label, text) rows; ``share``: how many of all labelled documents are toxic."""
    rows = sorted(rows, key=lambda r: xxhash.xxh3_64_intdigest(repr(r)))
    if {y for y, _ in rows} != {0, 1}:
        return None
    docs = [(y, vocabulary(t)) for y, t in rows]
    held = [r for i, r in enumerate(rows) if i % 4 == 3]
    diff = train_words([d for i, d in enumerate(docs) if i % 4 != 3])
    if {y for y, _ in held} != {0, 1}:
        held = rows
    x = np.array([text_logits(t, diff)[0] for _, t in held])
    y = np.array([y for y, _ in held])
    w = logistic(x, y)
    # the sample holds more toxic documents than the corpus
    share = min(max(share, 1e-6), 1 - 1e-6)
    w[-1] += np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean()))
    # temperature and prior are those of words not seen; the words come from all documents in the end
    return Model(train_words(docs), w)


def toxicity(docs: DataFrame, labels: DataFrame, out: str = "toxicity", *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", most: int = MOST, longest: int = LONGEST) -> DataFrame:
    """``docs`` with the struct ``out``: score, words (up to 100 that look toxic).

    Labels count only for ids whose remainder modulo 3 is not 1.
    """
    spark = docs.sparkSession
    prepare(spark)
    known = labels.select(F.col(doc_id).alias("i"), F.col(label).cast("int").alias("y")).where((remainder("i", 3) != 1) & F.col("y").isin(0, 1))
    known = known.groupBy("i").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z").select("i", "y")
    rows = docs.select(F.col(doc_id).alias("i"), F.col(text).alias("t")).where((remainder("i", 3) != 1) & has_letters(F.col("t")))
    # a bounded set of labelled ids with a text first, so that only their texts travel
    few = durable(labelled_sample(known.join(rows.select("i"), "i", "left_semi"), "y", F.xxhash64("i"), most))
    # at most twice ``most`` ids, so a broadcast of a proven size
    rows = rows.join(F.broadcast(few), "i").groupBy("i", "y").agg(F.min(excerpt(F.col("t"), longest)).alias("t")).select("y", "t")
    share = known.agg(F.avg("y")).first()[0] or 0.5
    held = spark.sparkContext.broadcast(train([(r["y"], r["t"]) for r in rows.collect()], share))

    def task():
        model = held.value
        return lambda t: (0.0, []) if model is None else model.score((t or b"").decode("utf-8", "replace"))

    return put(docs, out, per_text(task, DDL, ["score", "words"])(F.col(text)))
