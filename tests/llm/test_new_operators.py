"""Filter audit, centroid clustering and product search against brute force, and their edge cases."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from curatio.llm import audit, centroids, mtree

DOCS = "doc_id long, text string, lang string, fails string, words string"


def corpus():
    """Copies, repeated rows, nulls, every filter failed and kept, long texts, words that only differ in case."""
    r = random.Random(11)
    text = lambda n, words=400: " ".join(r.choice(["the", "The", "été", "ß"]) + str(r.randrange(words)) for _ in range(n))
    rows = [(i, text(r.choice([20, 99, 100, 101, 300]), r.choice([30, 5000])), r.choice(["en", "de", None, ""])) for i in range(60)]
    rows += [(100 + i, rows[3][1], "en") for i in range(4)] + [(99, rows[100 % 60][1], "de")]
    rows += [(200, None, "en"), (201, "", "en"), (202, " \n\t", None), (203, None, "fr"), (None, rows[3][1], "en"), (None, None, None)]
    rows += [(204, text(120) + " #", "en"), (205, "A" * 30 + " " + text(120, 9000), "en"), (206, text(20000), "en"), (207, text(20000, 10**6), "xx")]
    rows += [rows[5], rows[5], (208, "a b\x1cc " * 150, "en"), (209, "É" * 50 + "A" * 5, "en"), (210, "\x0bx\x0c y\r" * 70, "en")]
    return [(*x, "old", "clash") for x in rows]


def brute_audit(rows, labels):
    """part, order, step -> counts, document by document."""
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    first = {}
    for i, t, *_ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    docs = []
    for i, t, part, *_ in rows:
        w, t = words(t), t or ""
        bad = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
               "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t]}
        own = [x for x in labels if i is not None and x[0] == i]
        docs.append((part or "", {k for k, v in bad.items() if v}, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    out, gone = {}, Counter()
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for k, f in enumerate(order):
                lost, kept = [d for d in left if f in d[1]], [d for d in left if f not in d[1]]
                redundant = sum(f in d[1] for d in mine) - len(lost)
                unique = sum(d[1] == {f} for d in mine)
                out[part, order, k + 1] = [len(kept), len(lost), redundant, unique, sum(d[2] for d in lost), sum(d[3] for d in lost)]
                gone[part, f] += len(lost)
                left = kept
    return {k: (*v, gone[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


LABELS = [(3, 1, 0), (5, 1, 1), (5, 0, None), (100, 0, 1), (206, 1, 1), (None, 1, 1), (999, 1, 1), (200, None, 1)]


@pytest.mark.parametrize("shard", [1, 2000, 1 << 22])
def test_audit_equals_brute_force(spark, shard):
    rows = corpus()
    got = audit.audit(spark.createDataFrame(rows, DOCS), spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int"),
                      shard_bytes=shard, bucket=1 << 20 if shard == 1 << 22 else 300)
    have = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got.collect()}
    assert have == brute_audit(rows, LABELS)


def test_term_matrix_counts_every_word(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, part, t) for i, t, part, *_ in rows], "doc_id long, part string, text string")
    texts = {hashlib.sha256((t or "").encode()).digest(): t or "" for _, t, *_ in rows}
    columns, met = {}, 0
    for m in audit.term_matrix(docs, shard_bytes=3000, bucket=500).collect():
        for j, d in enumerate(m.docs):
            a, b = m.indptr[j], m.indptr[j + 1]
            assert m.indices[a:b] == sorted(set(m.indices[a:b]))
            got, want = dict(zip(m.indices[a:b], m.data[a:b])), Counter(re.findall(r"[^\x20\x09-\x0D]+", texts[bytes(d.digest)]))
            assert sorted(got.values()) == sorted(want.values())
            met += 1
            # a word's column is the same in all shards: narrow it down by the counts
            for w, n in want.items() if len(want) < 500 else ():
                cols = {c for c, k in got.items() if k == n}
                columns[w] = columns.get(w, cols) & cols
                assert columns[w]
    assert met == len(rows)


def test_audit_of_nothing(spark):
    none = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(none, labels).count() == 0
    # only texts without words
    got = audit.audit(spark.createDataFrame([(1, None, None, "", ""), (2, "", None, "", "")], DOCS), labels).collect()
    assert len(got) == 600 and {r.part for r in got} == {""}
    assert {(r.removed, r.kept) for r in got if r.filter_order == "ABCDE" and r.step == 1} == {(2, 0)}


VECS = "vec_id long, embedding array<double>, cluster string, score string"


def brute_clusters(rows, k=40, rounds=5):
    kept = [(i, [int(np.floor(256 * np.float64(x))) for x in v]) for i, v, *_ in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    centre = [v for _, v in first]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centre))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centre = [[sum(x) // len(x) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(centre)]
    last = [(i, *near(v)[::-1]) for i, v in kept]
    total = Counter()
    for _, j, d in last:
        total[j] += d
    return Counter((i, j, d, total[j], sum(total.values()), hashlib.sha256(",".join(map(str, centre[j])).encode()).hexdigest()) for i, j, d in last)


def vectors(n, dim=64, spread=0.02, groups=6):
    r = np.random.default_rng(4)
    middle = r.normal(size=(groups, dim))
    rows = [(i, (middle[i % groups] + spread * r.normal(size=dim)).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[2][1]) for i in range(9)] + [rows[7], rows[7]]
    rows += [(2000, None), (2001, []), (2002, [1.0] * (dim - 1) + [None]), (2003, [float("nan")] * dim), (2004, [float("inf")] * dim)]
    rows += [(2005, [0.0] * dim), (None, [0.5] * dim), (2006, [-0.001] * dim), (2007, [0.001] * dim), (2008, [3.0] * (dim + 1)), (2009, [100.0] * dim)]
    return [(*x, "c", "s") for x in rows]


@pytest.mark.parametrize("n", [20, 150])
def test_clusters_equal_brute_force(spark, n):
    rows = vectors(n)
    got = centroids.cluster(spark.createDataFrame(rows, VECS).repartition(3))
    have = Counter(tuple(r) for r in got.drop("computed").collect())
    assert have == brute_clusters(rows)
    # the groups are far apart: the bounds leave out most distances
    assert 0 < got.selectExpr("sum(computed)").first()[0] < 0.9 * got.count() * 40


def test_bounds_never_exceed_the_distance():
    r = np.random.default_rng(1)
    x, c = r.integers(-300, 300, (200, 8)), r.integers(-300, 300, (30, 8))
    x[:20] = c[:20]
    p = centroids.far_apart(c, 8)
    low = centroids.Bounds(p, c).lower(centroids.distances(x, p))
    exact = centroids.distances(x, c)
    assert (low <= exact).all() and (low > 0.5 * exact).any()
    number, best, computed = centroids.nearest(x, c, low)
    d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert (number == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all() and computed < d.size
    # pivots that coincide, and a single one, say nothing and break nothing
    one = centroids.far_apart(np.array([[1, 2], [1, 2]]), 8)
    assert len(one) == 1 and (centroids.Bounds(one, one).lower(centroids.distances(one, one)) == 0).all()


def test_clusters_of_nothing_and_of_too_large(spark):
    assert centroids.cluster(spark.createDataFrame([], VECS)).count() == 0
    assert centroids.cluster(spark.createDataFrame([(1, None, "", ""), (2, [1.0], "", "")], VECS)).count() == 0
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(spark.createDataFrame([(1, [1e300] * 64, "", "")], VECS))


def brute_products(rows, scale=64, most=20, step=20):
    ok = [(i, [int(np.floor(scale * np.float64(x))) for x in v]) for i, v, *_ in rows
          if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = Counter()
    for n, (q, x) in enumerate(ok):
        if q is None or q % step:
            continue
        found = sorted((-sum(a * b for a, b in zip(x, y)), i is None, i or 0) for m, (i, y) in enumerate(ok) if m != n)
        out.update((q, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(found[:most]))
    return out


@pytest.mark.parametrize("sizes", [(1024, 4096, 512, 16, 16384), (7, 30, 4, 3, 5), (1, 10**6, 2, 2, 1)])
def test_products_equal_brute_force(spark, monkeypatch, sizes):
    for name, size in zip(("ROOTS", "TREE", "BLOCK"), (sizes[0], sizes[1], sizes[4])):
        monkeypatch.setattr(mtree, name, size)
    rows = [r for r in vectors(260) if r[0] != 2004]
    r = np.random.default_rng(8)
    # lengths differ, and half of all rows are one vector
    rows += [(3000 + 10 * i, (r.normal(size=64) * 3.0 ** r.integers(-2, 3)).tolist(), "", "") for i in range(60)]
    rows += [(5000 + i, [0.25] * 64, "", "") for i in range(300)]
    df = spark.createDataFrame(rows, VECS)
    got = mtree.top_products(df.repartition(5), df["vec_id"] % 20 == 0, leaf=sizes[2], fan=sizes[3])
    assert Counter(tuple(x) for x in got.collect()) == brute_products(rows)


def test_products_of_few_none_and_large(spark):
    empty = spark.createDataFrame([], VECS)
    assert mtree.top_products(empty, empty["vec_id"] % 20 == 0).count() == 0
    df = spark.createDataFrame([(20, [], "", ""), (1, [1.0], "", ""), (2, None, "", "")], VECS)
    assert [tuple(r) for r in mtree.top_products(df, df["vec_id"] % 20 == 0).collect()] == [(20, 1, 1, 0)]
    alone = spark.createDataFrame([(40, [1.0], "", "")], VECS)
    assert mtree.top_products(alone, alone["vec_id"] % 20 == 0).count() == 0
    assert mtree.top_products(df, df["vec_id"] == 7).count() == 0
    # products beyond 2^53 stay exact
    big = [(20, [3.0e6, 1.0], "", ""), (1, [3.0e6, 1.0], "", ""), (2, [3.0e6, 2.0], "", "")]
    df = spark.createDataFrame(big, VECS)
    assert Counter(tuple(x) for x in mtree.top_products(df, df["vec_id"] % 20 == 0).collect()) == brute_products(big)
    huge = spark.createDataFrame([(20, [1e12], "", "")], VECS)
    with pytest.raises(ValueError):
        mtree.top_products(huge, huge["vec_id"] % 20 == 0)


def test_tree_search_leaves_out_what_is_far():
    r = np.random.default_rng(2)
    x = np.concatenate([r.integers(-5, 5, (400, 8)) + m for m in r.integers(-900, 900, (12, 8))]).astype(np.int64)
    space = mtree.Space(8, int((x * x).sum(axis=1).max()))
    rows = space.rows(x.tobytes())
    import pandas as pd

    f = pd.DataFrame({"z": [v.tobytes() for v in x], "ids": [[i] for i in range(len(x))], "none": [[False]] * len(x), "rows": [[i] for i in range(len(x))]})
    pages = {p.page: mtree.Page(p, space) for p in mtree.build(space, rows[:1])((0, 0), f).itertuples()}
    for q in rows[::311]:
        best, computed = mtree.best_first(pages, q, space, rows[0], 21, -np.inf)
        want = sorted((-int(s), False, i) for i, s in enumerate(rows @ q))[:21]
        assert [b[:3] for b in best] == want and computed < len(x) / 2


def test_many_equal_rows_lose_their_words_once(spark):
    from pyspark.sql import functions as F

    from curatio.llm import substrings

    text = " ".join(f"w{i * 7919 % 1000}" for i in range(500))
    rows = spark.range(5000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(text).alias("text"))
    other = spark.createDataFrame([(1, " ".join(f"v{i}" for i in range(90))), (2, " ".join(text.split()[:40])), (3, None)], "doc_id long, text string")
    got = substrings.remove_repeats(rows.unionByName(other), "r").groupBy("doc_id", "r.n_words", "r.n_removed").count().collect()
    assert sorted(tuple(r) for r in got if r.doc_id) == [(1, 90, 0, 1), (2, 40, 40, 1), (3, 0, 0, 1)]
    assert [tuple(r) for r in got if r.doc_id is None] == [(None, 500, 500, 5000)]


def test_toxic_words_are_learned_from_few_documents():
    from curatio.llm import toxicity

    r = random.Random(3)
    syllables = ["ta", "lo", "mi", "re", "so", "un", "ke", "vi", "pa", "od"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
    bad = ["grubby", "zilch", "frumpy", "wretch"]

    def doc(y):
        w = [word() for _ in range(r.choice([15, 80, 400]))]
        for _ in range(2 * y):
            w[r.randrange(len(w))] = r.choice(bad)
        return y, " ".join(w)

    rows = [doc(int(i % 8 == 0)) for i in range(280)]
    model = toxicity.train(rows, 0.125)
    held = [doc(int(i % 5 == 0)) for i in range(200)]
    marked = [(y, model.score(t)[0] >= 0.7) for y, t in held]
    assert sum(m for y, m in marked if y) >= 38 and not any(m for y, m in marked if not y)
    # letters that were never seen in this order share n-grams with words that were
    assert model.score("ta lo wretchh mi")[0] > model.score("ta lo remiso mi")[0]
    assert set(toxicity.telling([(y, toxicity.vocabulary(t)) for y, t in rows])[0]) == set(bad)


def test_ids_with_both_labels_teach_nothing(spark):
    from curatio.llm import toxicity

    docs = [(i, "good plain words here" if i % 2 else "nasty plain words here") for i in range(60)]
    labels = [(i, int(i % 2 == 0)) for i in range(60)]
    df = spark.createDataFrame(docs + docs[:3], "doc_id long, text string")
    scores = lambda lab: {(r.doc_id, r.t["score"]) for r in toxicity.toxicity(df, spark.createDataFrame(lab, "doc_id long, toxic int"), "t").collect()}
    both = [(i, 1 - y) for i, y in labels[:4]]
    without = scores([x for x in labels if x[0] >= 4])
    assert scores(labels + both) == without and len({s for _, s in without}) == 2
