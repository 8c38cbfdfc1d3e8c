"""op6_substrings: words, cuts and removals by the batch, and only what can repeat in the automata."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard

from curatio.llm import substrings as ss

SPACES = ["  ", "\n", "\t ", "\x0b", "\x0c\r"]


def texts(r, n):
    some = ["a", "b", "a\x00", "\x00a", " ", "\x1c", "é" * 3, "x" * 64, "x" * 65, "y" * 300]
    out = ["", " ", "one", " one\n"]
    for _ in range(n):
        out.append(r.choice(["", " "]) + "".join(r.choice(some) + r.choice([" ", *SPACES]) for _ in range(r.randrange(60))))
    return [t.encode() for t in out]


def flat(parts):
    at = np.concatenate(([0], np.cumsum([len(t) for t in parts]))).astype(np.int64)
    return np.frombuffer(b"".join(parts), dtype=np.uint8), at


def test_words_of_a_batch_are_those_of_each_text(monkeypatch):
    parts = texts(random.Random(1), 40)
    expected = [t.split() for t in parts]
    ids = {}
    for piece in (ss.PIECE, 100):  # the second cuts texts and meets words longer than a piece
        monkeypatch.setattr(ss, "PIECE", piece)
        h, off = ss.text_words(*flat(parts))
        assert np.diff(off).tolist() == [len(w) for w in expected]
        for w, x in zip([w for t in expected for w in t], h.tolist()):
            assert ids.setdefault(w, x) == x
    assert len(set(ids.values())) == len(ids)


def test_no_words():
    h, off = ss.text_words(*flat([b"", b""]))
    assert len(h) == 0 and off.tolist() == [0, 0, 0]
    assert [len(x) for x in ss.segments(h, off)] == [0] * 5


def test_segments_are_cut_at_the_smallest_gram_and_at_texts():
    r = random.Random(2)
    parts = [" ".join(r.choice("abcdefgh") for _ in range(n)).encode() for n in (9, 200, 0, 10, 11, 70, 3)]
    h, off = ss.text_words(*flat(parts))
    got = {}
    for t, anchor, seg, first, n in zip(*(x.tolist() for x in ss.segments(h, off, 10, 3))):
        for w in range(first, first + n):
            got[t, w] = anchor
        words = parts[t].split()[first : first + n + 9]
        assert got.setdefault(("seg", seg), words) == words
    exp = {}
    for t in range(len(parts)):
        g = ss.window_hashes(h[off[t] : off[t + 1]], 3)
        for w in range(off[t + 1] - off[t] - 9):
            exp[t, w] = int(g[w : w + 8].min().view(np.int64))
    assert {k: v for k, v in got.items() if k[0] != "seg"} == exp


def batch(rows):
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    cols = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays(cols, names=["anchor", "seg", "times", "words"])


def pack(words):
    return np.array(words, dtype=np.int64).tobytes()


def test_only_words_that_can_repeat_enter_an_automaton(monkeypatch):
    """Three segments that share 40 words, and one that shares nothing: the automaton reads 40 words, not 320."""
    read = []
    add = ss.Automaton.add
    monkeypatch.setattr(ss.Automaton, "add", lambda self, seq, times: (read.append((len(seq), times)), add(self, seq, times))[1])
    shared = list(range(40))
    rows = [(7, i, 1, pack([1000 * i + k for k in range(20)] + shared + [2000 * i + k for k in range(20)])) for i in (1, 2, 3)]
    rows.append((7, 4, 1, pack(range(5000, 5080))))
    found = [r for b in ss.shard(35)(iter([batch(rows)])) for r in b.to_pylist()]
    assert read == [(40, 3)]
    assert found == [{"anchor": 7, "seg": i, "w": [{"b": 20, "e": 60}]} for i in (1, 2, 3)]


def test_shards_against_brute_force():
    """Several anchors over batches of any size, segments of one count and of several, windows that overlap themselves."""
    r = random.Random(3)
    rows = []
    for a in sorted(r.sample(range(-50, 50), 25)):
        seqs = {pack([r.randrange(2) for _ in range(r.randint(4, 14))]) for _ in range(r.randint(1, 6))}
        rows += [(a, s, r.choice([1, 1, 1, 2, 5]), x) for s, x in enumerate(sorted(seqs))]
    exp = set()
    for a in {x[0] for x in rows}:
        count = Counter()
        seqs = {s: (t, np.frombuffer(x, dtype=np.int64).tolist()) for b, s, t, x in rows if b == a}
        for t, x in seqs.values():
            for k in range(len(x) - 3):
                count[tuple(x[k : k + 4])] += t
        for s, (_, x) in seqs.items():
            exp |= {(a, s, i) for k in range(len(x) - 3) if count[tuple(x[k : k + 4])] > 1 for i in range(k, k + 4)}
    for size in (1, 2, 7, len(rows)):
        batches = [batch(rows[i : i + size]) for i in range(0, len(rows), size)]
        found = [x for b in ss.shard(4)(iter(batches)) for x in b.to_pylist()]
        assert {(x["anchor"], x["seg"], i) for x in found for w in x["w"] for i in range(w["b"], w["e"])} == exp


def test_removal_by_the_batch(monkeypatch):
    r = random.Random(4)
    parts = [None, *texts(r, 60), None]
    spans, exp = [], []
    for t in parts:
        at = [] if t is None else t.split()
        sp = []
        if at and r.random() < 0.7:
            for _ in range(r.randint(1, 4)):
                b = r.randrange(len(at))
                sp.append({"b": b, "e": r.randint(b + 1, len(at))})
        cut = {i for x in sp for i in range(x["b"], x["e"])}
        spans.append(sp or None)
        exp.append((len(at), len(cut), None if t is None else [w for i, w in enumerate(at) if i not in cut], t if not sp else None))
    z = pa.array([None if t is None else zstandard.compress(t) for t in parts], pa.binary())
    sp = pa.array(spans, pa.list_(pa.struct([("b", pa.int32()), ("e", pa.int32())])))
    for piece in (ss.PIECE, 200):
        for x, y in ((z, sp), (z[3:50], sp[3:50]), (z[:0], sp[:0])):
            monkeypatch.setattr(ss.pieces, "__defaults__", (piece,))
            got = ss.removal(x, y).to_pylist()
            start = 3 if len(x) == 47 else 0
            assert len(got) == len(x)
            for g, (n, removed, kept, whole) in zip(got, exp[start:]):
                assert (g["n_words"], g["n_removed"]) == (n, removed)
                assert kept is None and g["kept"] is None or g["kept"].split() == kept
                assert whole is None or g["kept"] == whole
                assert sum(s["end"] - s["begin"] for s in g["spans"]) == removed


def test_query_on_long_texts_and_words(spark, tmp_path):
    """Texts beyond a piece, words beyond a piece, repeated rows, null ids and texts: the contract's columns by brute force."""
    from curatio.llm.queries import op6_substrings

    r = random.Random(6)
    text = lambda n: " ".join(f"{r.getrandbits(40):x}" for _ in range(n))
    long, huge, passage = text(130000), "z" * (ss.PIECE + 10), text(50)
    rows = [(1, long), (2, " ".join(long.split()[1000:1100])), (3, f"{text(30)} {huge}\n{passage}\t"), (4, f"\t{passage} {huge}  {text(40)}")]
    rows += [(5, text(60)), (5, rows[0][1][:700]), (None, passage), (None, None), (6, ""), (7, passage), (7, passage), (8, " ".join(["ta"] * 80))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    split = [(i, (t or "").split()) for i, t in rows]
    count = Counter(tuple(w[k : k + 35]) for _, w in split for k in range(len(w) - 34))
    exp = Counter()
    for i, w in split:
        cut = {j for k in range(len(w) - 34) if count[tuple(w[k : k + 35])] > 1 for j in range(k, k + 35)}
        kept = " ".join(x for j, x in enumerate(w) if j not in cut)
        exp[i, len(w), len(cut), hashlib.sha256(kept.encode()).hexdigest()] += 1
    got = op6_substrings(spark, str(tmp_path)).collect()
    assert Counter((x.doc_id, x.n_words, x.n_removed, x.kept_sha256) for x in got) == exp
