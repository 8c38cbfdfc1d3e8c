"""Property tests on random small inputs (hypothesis drives the data, Spark runs the operators)."""

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from curatio.operators import aggregates as A
from curatio.operators import joins as E
from curatio.operators.filters import since
from curatio.operators.sets import union_versions

keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))
SETTINGS = settings(max_examples=6, deadline=None, phases=[Phase.explicit, Phase.generate],
                    suppress_health_check=list(HealthCheck))



@SETTINGS
@given(rows=st.lists(st.tuples(keys, st.integers(0, 9)), max_size=12),
       lst=st.lists(keys, max_size=4))
def test_anti_and_semi_split_the_input(spark, rows, lst):
    df = spark.createDataFrame(rows, "k string, v int")
    side = spark.createDataFrame([(x,) for x in lst], "k string")
    kept = [tuple(r) for r in E.retain(df, side, "k").collect()]
    dropped = [tuple(r) for r in E.exclude(df, side, "k").collect()]
    assert sorted(kept + dropped, key=repr) == sorted(rows, key=repr)
    members = set(lst)
    assert all((r[0] in members) for r in kept)


@SETTINGS
@given(rows=st.lists(st.tuples(keys, st.integers(0, 3), st.integers(0, 1000)), max_size=15, unique_by=lambda r: r[2]))
def test_keep_first_is_idempotent_and_picks_minimum(spark, rows):
    df = spark.createDataFrame(rows, "k string, v int, seq int")
    once = A.keep_first(df, ["k"], ["seq"])
    twice = A.keep_first(once, ["k"], ["seq"])
    a = sorted((tuple(r) for r in once.collect()), key=repr)
    assert a == sorted((tuple(r) for r in twice.collect()), key=repr)
    expect = {}
    for r in rows:
        if r[0] not in expect or r[2] < expect[r[0]][2]:
            expect[r[0]] = r
    assert a == sorted(expect.values(), key=repr)


@SETTINGS
@given(days=st.lists(st.integers(0, 30), max_size=10), cut=st.integers(0, 30))
def test_union_commutes_with_start_filter(spark, days, cut):
    import datetime as dt

    base = dt.datetime(2018, 1, 1)
    rows = [(i, base + dt.timedelta(days=d)) for i, d in enumerate(days)]
    half = len(rows) // 2
    a = spark.createDataFrame(rows[:half], "id int, ts timestamp")
    b = spark.createDataFrame(rows[half:], "id int, ts timestamp")
    start = (base + dt.timedelta(days=cut)).strftime("%Y-%m-%d")
    left = since(union_versions([a, b]), "ts", start)
    right = union_versions([since(a, "ts", start), since(b, "ts", start)])
    assert sorted(r.id for r in left.collect()) == sorted(r.id for r in right.collect())
