"""Benchmark decontamination with one Aho-Corasick automaton over the normalised items.

Texts and items are normalised alike (A-Z lower-cased, words joined by one
space).  Every run of ``window`` consecutive words of an item is a pattern;
an item with fewer words, but not none, is one pattern.  The patterns, framed
by spaces, form one automaton; each text is read once, and the match ends are
mapped back to words and to character offsets of the original text.

The items are the only thing every task holds, so their size is checked
before they are broadcast: more than ``max_item_bytes`` is refused with an
error.  ``max_pattern_bytes`` bounds the patterns of one automaton; more are
dealt over as many automata as that needs, read one after the other.
Documents are never shuffled.

Defined results: a null or empty text has no words and no hits; an item that
is null or has no words never occurs; equal items all count; repeated
documents are judged one by one; an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.llm.common import per_text, prepare, put

WINDOW = 13
MAX_PATTERN_BYTES = 64 << 20
MAX_ITEM_BYTES = 256 << 20
DDL = "n_words long, n_hit long, item_ids array<string>, spans array<struct<begin:long,end:long>>"
FIELDS = ["n_words", "n_hit", "item_ids", "spans"]

# Words are runs of [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing A-Z; all
# other characters become spaces, byte by byte (UTF-8 bytes from 0x80 up stay).
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_BUILT: dict[str, list] = {}


def normalise(text: bytes | None) -> bytes:
    """Words joined by single spaces, with a space at both ends."""
    words = (text or b"").translate(NORMAL).split()
    return b" " + b" ".join(words) + b" " if words else b" "


def item_windows(text: bytes | None, window: int) -> list[bytes]:
    words = normalise(text).split()
    if not words:
        return []
    return [b" " + b" ".join(words[i : i + window]) + b" " for i in range(max(1, len(words) - window + 1))]


def shards(items: list[tuple[str, bytes]], window: int, max_bytes: int) -> list[dict[bytes, list[str]]]:
    """Patterns with the items that hold them, dealt into dictionaries of at most ``max_bytes`` of patterns."""
    out: list[dict[bytes, list[str]]] = [{}]
    size = 0
    for item, text in items:
        for p in set(item_windows(text, window)):
            size += len(p)
            if size > max_bytes and out[-1]:
                out.append({})
                size = len(p)
            out[-1].setdefault(p, []).append(item)
    return [s for s in out if s]


def automata(key: str, items: list[tuple[str, bytes]], window: int, max_bytes: int) -> list:
    """Automata of this Python worker, built once for each benchmark."""
    import ahocorasick

    if key not in _BUILT:
        _BUILT.clear()
        built = []
        for shard in shards(items, window, max_bytes):
            a = ahocorasick.Automaton()
            for p, ids in shard.items():
                a.add_word(p.decode("latin-1"), (p.count(b" ") - 1, ids))
            a.make_automaton()
            built.append(a)
        _BUILT[key] = built
    return _BUILT[key]


def char_spans(text: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """Character ranges of the original text that the runs of hit words cover."""
    flat = np.frombuffer(text.translate(NORMAL), dtype=np.uint8) != 32
    edge = np.diff(np.concatenate(([False], flat, [False])).astype(np.int8))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    turn = np.diff(np.concatenate(([False], hit, [False])).astype(np.int8))
    first, last = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1) - 1
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)))
    return [(int(chars[begins[a]]), int(chars[ends[b]])) for a, b in zip(first, last)]


def scan(text: bytes | None, built: list) -> tuple:
    norm = normalise(text)
    n = norm.count(b" ") - 1
    if n <= 0:
        return 0, 0, [], []
    as_text = norm.decode("latin-1")
    found = [m for a in built for m in a.iter(as_text)]
    if not found:
        return n, 0, [], []
    gaps = np.flatnonzero(np.frombuffer(norm, dtype=np.uint8) == 32)
    stop = np.searchsorted(gaps, [e for e, _ in found])
    mark = np.zeros(n + 1, dtype=np.int64)
    np.add.at(mark, stop - np.array([v[0] for _, v in found]), 1)
    np.add.at(mark, stop, -1)
    hit = np.cumsum(mark[:n]) > 0
    return n, int(hit.sum()), sorted({i for _, v in found for i in v[1]}), char_spans(text, hit)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, out: str = "contamination", *, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, max_pattern_bytes: int = MAX_PATTERN_BYTES, max_item_bytes: int = MAX_ITEM_BYTES,
) -> DataFrame:
    """``docs`` with the struct ``out``: n_words, n_hit, item_ids (sorted strings), spans (characters)."""
    spark = docs.sparkSession
    prepare(spark)
    rows = benchmark.select(F.col(item_id).cast("string"), F.col(item_text).cast("binary")).where(
        F.col(item_id).isNotNull() & F.col(item_text).isNotNull()
    )
    size = rows.agg(F.sum(F.octet_length(item_text) + F.octet_length(item_id))).first()[0] or 0
    if size > max_item_bytes:
        raise ValueError(f"the benchmark holds {size} bytes; max_item_bytes allows {max_item_bytes}")
    items = sorted((r[0], bytes(r[1])) for r in rows.toLocalIterator())
    key = hashlib.sha256(repr((items, window, max_pattern_bytes)).encode()).hexdigest()
    held = spark.sparkContext.broadcast(items)

    def task():
        built = automata(key, held.value, window, max_pattern_bytes)
        return lambda t: scan(t, built)

    return put(docs, out, per_text(task, DDL, FIELDS)(F.col(text)))


def contaminated(r: Column) -> Column:
    """At least one word in twenty lies inside an occurrence of a window."""
    return (r["n_hit"] > 0) & (F.lit(20) * r["n_hit"] >= r["n_words"])
