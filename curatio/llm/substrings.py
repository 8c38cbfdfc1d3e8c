"""Substring deduplication with suffix automata over shards of the repeated text.

A window of ``WINDOW`` consecutive words is repeated if its words also start
anywhere else, in the same document or another.  Every word that a repeated
window covers is removed; windows are judged on the input.

Reading every document against the automata of every other shard would cost
documents times shards, so shards are keyed by content:

1. The smallest hash among the ``GRAM``-word grams of a window is its anchor.
   Equal windows have equal anchors, and about one word in sixteen starts one.
   Consecutive windows with one anchor form a segment.
2. Anchors are counted over all documents.  One that occurs once has no
   repeated window.  If all segments of an anchor are equal, all are repeated.
3. The different segments of each other anchor, with their multiplicities, are
   a reference shard.  Its suffix automaton is built in the task that holds
   the shard, and the segments are streamed through it: the matching statistic
   at a word is the length of the longest match that ends there and occurs
   twice.  Where it reaches ``WINDOW``, the window that ends there is repeated.
   Only runs of windows whose hash occurs twice in the shard enter it, equal runs as one
   with their count: other windows have nothing to find.
4. Anchors with more than ``MAX_SEGMENTS`` different segments would make a
   shard too large for a task.  Their windows are counted by hash instead, with
   partial aggregation, which is exact as well and spreads over all tasks.
5. The spans, a set for each different text, go back to the documents, merged to
   maximal spans of words.

Copies meet as counts, never as pairs: a text is known by 128 bits of hashes, its
words are read once and its spans are kept once, however many rows hold it.  Hashes
of segments and windows have 64 bits and are compared within an anchor, so 128 bits
stand for them as well.

Defined results: a null or empty text has no words; repeated rows are
occurrences of their own; a null id is like any other value; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curatio.llm.common import _powers, durable, fresh, mix, packed, per_text, prepare, window_hashes

WINDOW = 35
GRAM = 6
MAX_SEGMENTS = 256
# Texts are read together up to so many bytes, so that their arrays stay small.
PIECE = 1 << 20
# Longer words are hashed one by one: sums of powers modulo 2^64 are weak for very long strings.
LONG_WORD = 64
SEGMENTS = "anchor array<long>, seg array<long>, at array<int>, n array<int>"
SPACE = np.isin(np.arange(256), list(b"\t\n\v\f\r "))
SALT = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def offsets(a: pa.Array) -> np.ndarray:
    """Offsets of a list or (large) binary array into its buffer of values."""
    wide = pa.types.is_large_binary(a.type) or pa.types.is_large_list(a.type)
    o = np.frombuffer(a.buffers()[1], dtype=np.int64 if wide else np.int32)
    return o[a.offset : a.offset + len(a) + 1].astype(np.int64)


def pieces(size: np.ndarray, most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items of at most ``most`` in all, or one item."""
    at = np.concatenate(([0], np.cumsum(size)))
    i = 0
    while i < len(size):
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, j
        i = j


def bounds(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each word of the texts ``buf[at[i]:at[i + 1]]``, and the number of each text's first word."""
    solid = ~SPACE[buf]
    edge = np.zeros(len(buf) + 1, dtype=bool)
    edge[at] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | edge[1:-1]
    first, end = np.flatnonzero(first), np.flatnonzero(end) + 1
    return first, end, np.searchsorted(first, at)


def text_words(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of the texts ``buf[at[i]:at[i + 1]]``, and the number of each text's first word."""
    first, end, off = bounds(buf, at)
    h = np.empty(len(first), dtype=np.uint64)
    w = 0
    while w < len(h):
        b = first[w]
        n = int(np.searchsorted(end, b + PIECE, "right"))
        if n > w:
            part = buf[b : end[n - 1]]
            up, dn = _powers(len(part))
            pre = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(SALT[part] * up, out=pre[1:])
            f = first[w:n] - b
            h[w:n] = mix((pre[end[w:n] - b] - pre[f]) * dn[f])
        w = max(n, w + 1)
    for i in np.flatnonzero(end - first > LONG_WORD):
        h[i] = xxhash.xxh3_64_intdigest(buf[first[i] : end[i]])
    return h, off


def first_smallest(g: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest of each ``width`` consecutive values."""
    at, have = np.arange(len(g)), 1
    while have < width:
        step = min(have, width - have)
        a, b = at[:-step], at[step:]
        at = np.where(g[b] < g[a], b, a)
        have += step
    return at


def segments(h: np.ndarray, off: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple:
    """(text, anchor, segment hash, first window, number of windows) for each run of windows with one anchor.

    Text i has the words ``h[off[i]:off[i + 1]]``.
    """
    size = np.diff(off)
    text = np.repeat(np.arange(len(size)), size)
    start = np.flatnonzero(np.arange(len(h)) + window <= off[1:][text])
    if not len(start):
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none, none
    g = window_hashes(h, gram)
    place = first_smallest(g, window - gram + 1)[start]
    run = np.flatnonzero(np.concatenate(([True], np.diff(place) != 0)))
    count = np.diff(np.concatenate((run, [len(start)])))
    first, place = start[run], place[run]
    up, dn = _powers(len(h))
    pre = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * up, out=pre[1:])
    end = first + count + window - 1
    # the anchor's place in the segment is part of the hash, so equal hashes are aligned alike
    seg = mix((pre[end] - pre[first]) * dn[first] + (place - first).astype(np.uint64) * np.uint64(0x100000001B3) + count.astype(np.uint64))
    text = text[first]
    return text, g[place].view(np.int64), seg.view(np.int64), first - off[text], count


def describe(window: int, gram: int):
    """mapInArrow over (keys, text as bytes): the segments of each text that has any."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            col = batch.column(batch.num_columns - 1)
            at = offsets(col)
            buf = np.frombuffer(col.buffers()[2] or b"", dtype=np.uint8)
            for i, j in pieces(np.diff(at)):
                h, off = text_words(buf[at[i] : at[j]], at[i : j + 1] - at[i])
                text, *found = segments(h, off, window, gram)
                have, first = np.unique(text, return_index=True)
                ends = pa.array(np.append(first, len(text)).astype(np.int32))
                keys = batch.select(list(range(batch.num_columns - 1))).take(pa.array(have + i))
                types = [np.int64, np.int64, np.int32, np.int32]
                lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(t))) for x, t in zip(found, types)]
                yield pa.RecordBatch.from_arrays(keys.columns + lists, names=keys.schema.names + ["anchor", "seg", "at", "n"])

    return run


class Automaton:
    """Suffix automaton of several sequences; states know how often their strings occur."""

    def __init__(self) -> None:
        self.length, self.link, self.go, self.times = [0], [-1], [{}], [0]

    def _new(self, length: int, link: int, go: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.go.append(go)
        self.times.append(0)
        return len(self.length) - 1

    def _clone(self, p: int, c: int, q: int) -> int:
        """Split from state q the strings that are reached from p by c."""
        k = self._new(self.length[p] + 1, self.link[q], dict(self.go[q]))
        while p != -1 and self.go[p].get(c) == q:
            self.go[p][c] = k
            p = self.link[p]
        self.link[q] = k
        return k

    def _extend(self, last: int, c: int) -> int:
        q = self.go[last].get(c)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, c, q)
        new, p = self._new(self.length[last] + 1, 0, {}), last
        while p != -1 and c not in self.go[p]:
            self.go[p][c] = new
            p = self.link[p]
        if p != -1:
            q = self.go[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, c, q)
        return new

    def add(self, seq: list[int], times: int) -> None:
        state = 0
        for c in seq:
            state = self._extend(state, c)
            self.times[state] += times

    def close(self) -> None:
        """Carry occurrences from long strings to their suffixes."""
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.times[self.link[s]] += self.times[s]

    def statistics(self, seq: list[int]) -> list[int]:
        """Length of the longest match that ends at each word and occurs at least twice."""
        out, state = [], 0
        for i, c in enumerate(seq):
            state = self.go[state][c]
            s = state
            while s > 0 and self.times[s] < 2:
                s = self.link[s]
            out.append(min(self.length[s], i + 1))
        return out


def often(seq: np.ndarray, at: np.ndarray, group: np.ndarray, times: np.ndarray, window: int) -> tuple:
    """(sequence, first window, number of windows) of each run of windows whose hash occurs twice in its group.

    Sequence i, of group ``group[i]``, has the words ``seq[at[i]:at[i + 1]]`` and occurs ``times[i]`` times.
    A window of another hash is not repeated, so none is missed here; a chance match only adds one to read.
    """
    row = np.repeat(np.arange(len(group)), np.diff(at))
    start = np.flatnonzero(np.arange(len(seq)) + window <= at[1:][row])
    row = row[start]
    h = window_hashes(seq, window)[start] + mix(group.astype(np.uint64))[row]
    _, same = np.unique(h, return_inverse=True)
    twice = np.bincount(same, weights=np.minimum(times, 2)[row])[same] > 1
    start, row = start[twice], row[twice]
    run = np.flatnonzero(np.concatenate(([True], (np.diff(start) != 1) | (np.diff(row) != 0)))[: len(start)])
    count = np.diff(np.concatenate((run, [len(start)])))
    return row[run], start[run] - at[row[run]], count


def repeated(runs: dict[bytes, int], window: int) -> dict[bytes, list[tuple[int, int]]]:
    """For {words: times} of one anchor: the word spans of each sequence that repeated windows cover."""
    a = Automaton()
    read = {words: np.frombuffer(words, dtype=np.int64).tolist() for words in runs}
    for words, times in runs.items():
        a.add(read[words], times)
    a.close()
    return {words: covered(a.statistics(seq), window) for words, seq in read.items()}


def covered(matches: list[int], window: int) -> list[tuple[int, int]]:
    """Spans of the windows that end where a match of at least ``window`` words ends."""
    out: list[list[int]] = []
    for e, m in enumerate(matches, 1):
        if m >= window:
            if out and e - window <= out[-1][1]:
                out[-1][1] = e
            else:
                out.append([e - window, e])
    return [(b, e) for b, e in out]


def shard(window: int):
    """mapInArrow over rows sorted by anchor: the repeated spans of each segment."""

    def found(rows: pa.Table) -> pa.RecordBatch:
        anchor, times = rows["anchor"].to_numpy(), rows["times"].to_numpy()
        group = np.cumsum(np.concatenate(([0], np.diff(anchor) != 0)))
        col = rows["words"].combine_chunks()
        at = offsets(col)
        seq = np.frombuffer(col.buffers()[2], dtype=np.uint64)[at[0] // 8 : at[-1] // 8]
        at = (at - at[0]) // 8
        shards: dict[int, dict[bytes, int]] = {}
        places = []
        r, b, n = often(seq, at, group, times, window)
        begin = at[r] + b
        end = begin + n + window - 1
        for k, t, r, b, x, y in zip(*(x.tolist() for x in (group[r], times[r], r, b, begin, end))):
            words = seq[x:y].tobytes()
            runs = shards.setdefault(k, {})
            runs[words] = runs.get(words, 0) + t
            places.append((r, b, runs, words))
        # each shard's counts give way to its spans
        for runs in shards.values():
            runs.update(repeated(runs, window))
        hits = [(r, b + x, b + y) for r, b, runs, words in places for x, y in runs[words]]
        r, b, e = np.array(hits, dtype=np.int64).reshape(-1, 3).T
        have, first = np.unique(r, return_index=True)
        w = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (b, e)], names=["b", "e"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(r)).astype(np.int32)), w)
        seg = rows["seg"].to_numpy()
        return pa.RecordBatch.from_arrays([pa.array(anchor[have]), pa.array(seg[have]), lists], names=["anchor", "seg", "w"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # their last anchor may go on in the next batch
        for batch in it:
            if not batch.num_rows:
                continue
            held.append(batch)
            anchor = batch.column("anchor").to_numpy()
            if held[0].column("anchor")[0].as_py() == anchor[-1]:
                continue
            begun = int(np.searchsorted(anchor, anchor[-1]))
            held[-1] = batch.slice(0, begun)
            yield found(pa.Table.from_batches(held))
            held = [batch.slice(begun)]
        if held:
            yield found(pa.Table.from_batches(held))

    return run


def slices(window: int):
    """mapInArrow over (compressed text, wanted segments): the words of each, as packed 64-bit hashes."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        z = zstandard.ZstdDecompressor()
        for batch in it:
            texts, wanted = batch.column("z"), batch.column("want")
            have = offsets(wanted)
            x = dict(zip([f.name for f in wanted.type.value_type], wanted.values.flatten()))
            first, count = (x[c].to_numpy().astype(np.int64) for c in ("at", "n"))
            for i, j in pieces(np.array([zstandard.frame_content_size(t) for t in texts.to_pylist()], dtype=np.int64)):
                read = [z.decompress(t) for t in texts.slice(i, j - i).to_pylist()]
                at = np.concatenate(([0], np.cumsum([len(t) for t in read]))).astype(np.int64)
                h, off = text_words(np.frombuffer(b"".join(read), dtype=np.uint8), at)
                rows = slice(have[i], have[j])
                begin = first[rows] + np.repeat(off[:-1], np.diff(have[i : j + 1]))
                size = count[rows] + window - 1
                for k, m in pieces(size):
                    b, n = begin[k:m], size[k:m]
                    end = np.cumsum(n)
                    words = h[np.arange(end[-1]) + np.repeat(b - end + n, n)]
                    ends = pa.py_buffer(np.append(0, end * 8).astype(np.int32))
                    words = pa.Array.from_buffers(pa.binary(), m - k, [None, ends, pa.py_buffer(words)])
                    same = [x[c].slice(have[i] + k, m - k) for c in ("anchor", "seg", "times", "big")]
                    yield pa.RecordBatch.from_arrays([*same, words], names=["anchor", "seg", "times", "big", "words"])

    return run


def hashes_of(window: int):
    """UDF: hash of every window of packed words."""
    return per_text(
        lambda: lambda b: (window_hashes(np.frombuffer(b, dtype=np.uint64), window).view(np.int64).tolist(),),
        "h array<long>", ["h"],
    )


def cuts(off: np.ndarray, text: np.ndarray, b: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, begin, end) of the maximal spans of words b to e of their texts, in order; ``off``: first word of each text."""
    b, e = b + off[text], e + off[text]
    order = np.lexsort((b, text))
    b, e, text = b[order], e[order], text[order]
    reach = np.maximum.accumulate(e)
    new = np.flatnonzero(np.concatenate(([True], (b[1:] > reach[:-1]) | (np.diff(text) != 0)))[: len(b)])
    end = reach[np.append(new[1:], len(b)) - 1] if len(b) else e
    return text[new], b[new], end


def removal(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """(n_words, n_removed, kept, spans) of compressed texts and the word spans to remove."""
    import zstandard

    z = zstandard.ZstdDecompressor()
    have = offsets(spans)
    sb, se = (x.to_numpy().astype(np.int64) for x in spans.values.flatten())
    zs = texts.to_pylist()
    out = []
    size = np.array([0 if t is None else zstandard.frame_content_size(t) for t in zs], dtype=np.int64)
    for i, j in list(pieces(size)) or [(0, 0)]:
        read = [b"" if t is None else z.decompress(t) for t in zs[i:j]]
        at = np.concatenate(([0], np.cumsum([len(t) for t in read]))).astype(np.int64)
        buf = np.frombuffer(b"".join(read), dtype=np.uint8)
        first, _, off = bounds(buf, at)
        rows = slice(have[i], have[j])
        text, b, e = cuts(off, np.repeat(np.arange(j - i), np.diff(have[i : j + 1])), sb[rows], se[rows])
        # a span takes the bytes up to the next word, or to the end of its text
        step = np.zeros(len(buf) + 1, dtype=np.int8)
        step[first[b]] = 1
        until = np.where(e == off[text + 1], at[text + 1], np.append(first, len(buf))[e])
        step[until] -= 1
        stays = np.cumsum(step[:-1], dtype=np.int8) == 0
        kept = np.concatenate(([0], np.cumsum(stays)))[at]
        valid = np.packbits(np.array([t is not None for t in zs[i:j]], dtype=bool), bitorder="little")
        kept = pa.Array.from_buffers(pa.binary(), j - i, [pa.py_buffer(valid), pa.py_buffer(kept.astype(np.int32)), pa.py_buffer(buf[stays])])
        removed = np.bincount(text, weights=e - b, minlength=j - i).astype(np.int64)
        ends = pa.array(np.searchsorted(text, np.arange(j - i + 1)).astype(np.int32))
        cut = pa.StructArray.from_arrays([pa.array(b - off[text]), pa.array(e - off[text])], names=["begin", "end"])
        cut = pa.ListArray.from_arrays(ends, cut)
        out.append(pa.StructArray.from_arrays([pa.array(np.diff(off)), pa.array(removed), kept, cut], names=["n_words", "n_removed", "kept", "spans"]))
    return pa.concat_arrays(out)


REMOVAL = "n_words long, n_removed long, kept binary, spans array<struct<begin:long,end:long>>"


def repeated_spans(docs: DataFrame, text: str, key: list[str], window: int, gram: int, max_segments: int) -> DataFrame:
    """key columns (hashes, never null), spans: the word spans that repeated windows cover, one row a key."""
    # ``window`` words need at least 2 * window - 1 characters
    docs = docs.where(F.length(text) >= 2 * window - 1)
    schema = StructType(docs.select(*key).schema.fields + StructType.fromDDL(SEGMENTS).fields)
    rows = durable(docs.select(*key, F.col(text).cast("binary").alias("t")).mapInArrow(describe(window, gram), schema))
    occ = rows.select(*key, F.explode(F.arrays_zip("anchor", "seg", "at", "n")).alias("x")).select(*key, "x.*")
    anchors = occ.groupBy("anchor").agg(F.count(F.lit(1)).alias("c"), F.min("seg").alias("lo"), F.max("seg").alias("hi"))
    # written first, so that the join deals out both sides anew and can split a hot anchor
    anchors = durable(anchors.where("c > 1").select("anchor", (F.col("lo") == F.col("hi")).alias("same")))
    met = durable(occ.join(anchors, "anchor"))
    whole = met.where("same").select(*key, F.col("at").alias("b"), (F.col("at") + F.col("n") + window - 1).alias("e"))

    # the different segments of the other anchors, with one place where each can be read
    mixed = met.where("NOT same")
    some = mixed.groupBy("anchor", "seg").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct(*key, "at", "n")).alias("p"))
    some = durable(some.select("anchor", "seg", "times", "p.*"))
    wide = some.groupBy("anchor").agg((F.count(F.lit(1)) > max_segments).alias("big"))
    want = some.join(wide, "anchor").groupBy(*key).agg(F.collect_list(F.struct("anchor", "seg", "at", "n", "times", "big")).alias("want"))
    # one row a text: rows that repeat it go before the shuffle
    z = docs.select(*key, packed()(F.col(text)).alias("z")).dropDuplicates(key).join(want, key)
    cut = durable(z.select("z", "want").mapInArrow(slices(window), "anchor long, seg long, times long, big boolean, words binary"))

    small = cut.where("NOT big").select("anchor", "seg", "times", "words")
    spans = "array<struct<b:int,e:int>>"
    hits = small.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(shard(window), f"anchor long, seg long, w {spans}")
    each = cut.where("big").select("anchor", "seg", "times", F.posexplode(hashes_of(window)(F.col("words"))["h"]).alias("w", "hash"))
    counted = each.groupBy("anchor", "hash").agg(F.sum("times").alias("t")).where("t > 1").select("anchor", "hash")
    span = F.struct(F.col("w").alias("b"), (F.col("w") + window).alias("e"))
    more = each.join(counted, ["anchor", "hash"]).groupBy("anchor", "seg").agg(F.collect_list(span).cast(spans).alias("w"))
    back = mixed.select(*key, "anchor", "seg", "at").join(hits.union(more), ["anchor", "seg"])
    back = back.select(*key, "at", F.explode("w").alias("w"))
    part = back.select(*key, (F.col("at") + F.col("w.b")).alias("b"), (F.col("at") + F.col("w.e")).alias("e"))
    return whole.union(part).groupBy(*key).agg(F.collect_set(F.struct("b", "e")).alias("spans"))


def remove_repeats(
    docs: DataFrame, out: str = "repeats", *, text: str = "text", window: int = WINDOW,
    gram: int = GRAM, max_segments: int = MAX_SEGMENTS,
) -> DataFrame:
    """``docs`` with the struct ``out``: n_words, n_removed, kept (the text without the removed words), spans (of words).

    A removed span takes the white space behind it along; the rest of the text
    stays as it is, and a text without repeats is unchanged.
    """
    prepare(docs.sparkSession)
    # two hashes of the text, chained to different beginnings
    one, two = F.xxhash64(F.col(text)), F.xxhash64(F.lit(1), F.col(text))
    d = docs.select(one.alias("g"), two.alias("h"), F.col(text).alias("t"))
    s = repeated_spans(d, "t", ["g", "h"], window, gram, max_segments)
    g, h, z, sp = [fresh(docs, n) for n in ("__g", "__h", "__z", "__spans")]
    s = s.select(F.col("g").alias(g), F.col("h").alias(h), F.col("spans").alias(sp))
    rest = [c for c in docs.columns if c not in (text,)]
    d = docs.select(*[F.col(f"`{c}`") for c in rest], one.alias(g), two.alias(h), packed(1)(F.col(text)).alias(z))
    d = d.join(s, [g, h], "left")
    r = F.arrow_udf(removal, REMOVAL)(z, sp)
    d = d.select(*[F.col(f"`{c}`") for c in rest], r.alias(fresh(docs, "__r")))
    r = F.col(fresh(docs, "__r"))
    value = F.struct(r["n_words"].alias("n_words"), r["n_removed"].alias("n_removed"), r["kept"].cast("string").alias("kept"), r["spans"].alias("spans"))
    return d.select(*[F.col(f"`{c}`") for c in rest if c.lower() != out.lower()], value.alias(out))
