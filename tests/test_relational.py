"""NULL rules and keyed-write semantics (FIXTURES §3) plus invariants."""

from pyspark.sql import functions as F

from sparkmart.operators import relational as R


def keys(df, c="k"):
    return sorted((r[c] for r in df.collect()), key=lambda v: (v is None, v))


def test_delete_not_in(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    ref = lambda rows: spark.createDataFrame(rows, "k int")
    assert keys(R.delete_not_in(df, "k", ref([(1,)]))) == [1, None]
    assert keys(R.delete_not_in(df, "k", ref([(1,), (None,)]))) == [1, 2, None]
    assert keys(R.delete_not_in(df, "k", ref([]))) == []


def test_delete_plus_survivors_is_input(spark):
    df = spark.range(50).select(F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id")).alias("k"))
    ref = spark.range(0, 50, 3).select(F.col("id").alias("k"))
    gone = R.anti_not_in(df, "k", ref)
    kept = R.delete_not_in(df, "k", ref)
    assert gone.count() + kept.count() == df.count()


def test_unseen(spark):
    src = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    assert keys(R.unseen(src, "k", spark.createDataFrame([(1,)], "k int"))) == [2]
    assert keys(R.unseen(src, "k", spark.createDataFrame([], "k int"))) == [1, 2, None]


def test_insert_ignore(spark):
    tgt = spark.createDataFrame([(1, "a")], "id int, val string")
    batch = spark.createDataFrame([(1, "b", 0), (2, "c", 1), (2, "d", 2), (3, None, 3), (4, None, 4)],
                                  "id int, val string, o int")
    added = R.insert_ignore(tgt, batch.drop("o"), "id", uniques=[["val"]], order_by=["id", "val"])
    assert sorted(added.collect(), key=lambda r: r.id) == [(2, "c"), (3, None), (4, None)]
    # idempotent: inserting the same batch into the result adds nothing
    full = tgt.unionByName(added)
    assert R.insert_ignore(full, batch.drop("o"), "id", uniques=[["val"]]).count() == 0


def test_insert_ignore_fk(spark):
    tgt = spark.createDataFrame([], "id int, p int")
    parent = spark.createDataFrame([(1,)], "p int")
    batch = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id int, p int")
    added = R.insert_ignore(tgt, batch, "id", fks=[(["p"], parent, ["p"])])
    assert keys(added, "id") == [1, 3]


def test_first_wins_and_lookup(spark):
    df = spark.createDataFrame([(1, "x", 2), (1, "y", 1), (None, "z", 0)], "k int, v string, o int")
    out = {r.v for r in R.first_wins(df, "k", ["o"]).collect()}
    assert out == {"y", "z"}
    left = spark.createDataFrame([(1,), (5,)], "k int")
    got = sorted(R.lookup_first(left, df, "k", ["o"]).collect(), key=lambda r: r.k)
    assert [(r.k, r.v) for r in got] == [(1, "y"), (5, None)]


def test_surrogate_key(spark):
    df = spark.range(100).select((F.col("id") * 7 % 100).alias("x")).repartition(5)
    out = R.with_surrogate_key(df, "sk", ["x"], start=10)
    rows = sorted((r.x, r.sk) for r in out.collect())
    assert [sk for _, sk in rows] == list(range(11, 111))


def test_cascade(spark):
    c = spark.createDataFrame([(1,), (2,)], "ck int")
    o = spark.createDataFrame([(10, 1), (20, 2)], "ok int, ck int")
    li = spark.createDataFrame([(10, 1), (20, 1), (20, 2)], "ok int, ln int")
    out = R.cascade_delete({"c": c, "o": o, "l": li}, [("c", "ck", "o", "ck"), ("o", "ok", "l", "ok")], "c", "ck",
                           spark.createDataFrame([(2,)], "ck int"))
    assert keys(out["c"], "ck") == [1] and keys(out["o"], "ok") == [10] and out["l"].count() == 1


def test_update_from(spark):
    t = spark.createDataFrame([(1, None), (2, 0)], "id int, v int")
    u = spark.createDataFrame([(1, 1)], "id int, p int")
    assert sorted(R.update_from(t, u, "id", {"v": "p"}).collect()) == [(1, 1), (2, 0)]


def _one_by_one(target, rows, keys):
    """Sequential insertion: the ids of the rows that go in."""
    held = set()
    for r in target:
        held |= {(i, tuple(r[c] for c in key)) for i, key in enumerate(keys)}
    out = []
    for r in rows:
        mine = {(i, tuple(r[c] for c in key)) for i, key in enumerate(keys) if all(r[c] is not None for c in key)}
        if not mine & held:
            held |= mine
            out.append(r["seq"])
    return out


def test_insert_ignore_with_several_keys_is_sequential_insertion(spark):
    import itertools
    import random
    cols = "seq int, a int, b string, c double"
    known = [  # the chains in which a rejected row must not shut out others
        ([["a"], ["b"]], [(1, 1, "p", 0.0), (2, 1, "q", 0.0), (3, 3, "q", 0.0)], [1, 3]),
        ([["a"], ["b"]], [(1, 1, "p", 0.0), (2, 2, "p", 0.0), (3, 2, "q", 0.0)], [1, 3]),
        ([["a"], ["b"], ["c"]], [(1, 1, "p", 1.0), (2, 1, "q", 2.0), (3, 2, "q", 3.0), (4, 2, "r", 2.0), (5, 9, "r", -0.0), (6, 8, "x", 0.0)],
         [1, 3, 5]),
    ]
    for keys, rows, want in known:
        for order in itertools.permutations(keys):
            got = R.insert_ignore(spark.createDataFrame([], cols), spark.createDataFrame(rows, cols), order[0], uniques=order[1:],
                                  order_by=["seq"])
            assert sorted(r["seq"] for r in got.collect()) == want
    rng = random.Random(3)
    pick = lambda n: None if rng.random() < 0.1 else rng.randrange(n)
    rows = [dict(seq=i, a=pick(90), b=(lambda v: v if v is None else f"b{v}")(pick(70)), c=float(rng.randrange(4))) for i in range(300)]
    target = [dict(seq=-i, a=i, b=f"b{100 - i}", c=0.0) for i in range(5)]
    keys = [["a"], ["b"], ["b", "c"]]
    tgt, batch = (spark.createDataFrame([tuple(r.values()) for r in x], cols) for x in (target, rows))
    got = R.insert_ignore(tgt, batch, "a", uniques=keys[1:], order_by=["seq"])
    assert sorted(r["seq"] for r in got.collect()) == _one_by_one(target, rows, keys)


def test_insert_ignore_breaks_ties_by_the_rows_values(spark):
    cols = "a int, b string, v int"
    rows = [(1, "x", 1), (1, "y", 2), (2, "x", 3), (2, "y", 4)]
    results = {tuple(sorted(map(tuple, R.insert_ignore(spark.createDataFrame([], cols), spark.createDataFrame(p, cols).repartition(n), "a",
                                                       uniques=[["b"]]).collect())))
               for p in (rows, rows[::-1]) for n in (1, 3)}
    assert len(results) == 1


def test_update_from_takes_one_update_whole(spark):
    t = spark.createDataFrame([("k", "0", "0"), ("m", "0", "0")], "k string, v string, w string")
    u = spark.createDataFrame([("k", "a", "z", 2), ("k", "b", "y", 1)], "k string, p string, q string, at int")
    got = R.update_from(t, u, "k", {"v": "p", "w": "q"}, order_by=["at"])
    assert sorted(map(tuple, got.collect())) == [("k", "b", "y"), ("m", "0", "0")]
    assert sorted(map(tuple, R.update_from(t, u, "k", {"v": "p", "w": "q"}).collect())) == [("k", "b", "y"), ("m", "0", "0")]
