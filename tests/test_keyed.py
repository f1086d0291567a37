import os
import random

import pytest
from pyspark.sql import functions as F

from platewise.session import work_path
from platewise.sources import keyed


def table(spark, keys=("k",), **kw):
    return keyed.PartitionedTable(work_path(spark, "keyed").removeprefix("file:"), list(keys), **kw)


def files(t):
    """{path: modification time} of the data files."""
    out = {}
    for d, _, names in os.walk(t.root + "/data"):
        out |= {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for n in names if n.endswith(".parquet")}
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v long")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upserts_equal_a_dict(spark):
    rng, t, want = random.Random(1), table(spark, buckets=16), {}
    assert t.read(spark) is None and t.lookup(frame(spark, [])) is None
    for n in (500, 3, 200, 1, 0):
        batch = {f"key{rng.randrange(600)}": rng.randrange(100) for _ in range(n)}
        t.upsert(frame(spark, [*batch.items(), (None, 7)]))
        want |= batch
        assert rows(t.read(spark)) == sorted(want.items())
    assert len(want) > 300


def test_untouched_files_stay(spark):
    t = table(spark, buckets=32)
    t.upsert(frame(spark, [(f"key{i}", i) for i in range(20_000)]))
    before = files(t)
    t.upsert(frame(spark, [("key5", -1), ("new", -2)]))
    after = files(t)
    added = set(after) - set(before)
    assert {p: after[p] for p in before} == before and 1 <= len(added) <= 2
    assert sum(os.path.getsize(p) for p in added) < sum(os.path.getsize(p) for p in before) / 8
    named = {p.removeprefix("file:").split("platewise_v=")[1] for p in t.read(spark).inputFiles()}
    assert len({n.split("/")[1] for n in named}) == len(named) == 32
    assert t.lookup(frame(spark, [("key5", 0), ("new", 0), ("none", 0)])).select("v").orderBy("v").collect() == [(-2,), (-1,)]
    for _ in range(2):  # replaced directories go when no kept version names them
        t.upsert(frame(spark, [("key5", -1), ("new", -2)]))
    left = set(files(t))
    assert len(left) <= 32 + 2 * len(added) and not {p for p in before if p in left} == set(before)


def test_lookup_reads_only_its_buckets(spark):
    t = table(spark, buckets=64)
    t.upsert(frame(spark, [(f"key{i}", i) for i in range(5000)]))
    one = t.lookup(frame(spark, [("key77", 0)]))
    assert rows(one) == [("key77", 77)] and len(one.inputFiles()) == 1
    assert "In(k, [key77])" in one._jdf.queryExecution().toString() or "EqualTo(k,key77)" in one._jdf.queryExecution().toString()
    many = t.lookup(frame(spark, [(f"key{i}", 0) for i in range(0, 5000, 2)] + [("absent", 0)] * 3 + [(None, 0)]))
    assert rows(many) == rows(frame(spark, [(f"key{i}", i) for i in range(0, 5000, 2)]))
    assert rows(t.lookup(frame(spark, [(None, 1)]))) == []


def test_a_key_twice_or_a_failed_write_changes_nothing(spark):
    t = table(spark, buckets=4)
    t.upsert(frame(spark, [("a", 1), ("b", 2)]))
    with pytest.raises(Exception, match="duplicate key"):
        t.upsert(frame(spark, [("c", 1), ("c", 2)]))
    assert rows(t.read(spark)) == [("a", 1), ("b", 2)]
    t.upsert(frame(spark, [("c", 3)]))
    assert rows(t.read(spark)) == [("a", 1), ("b", 2), ("c", 3)]


def test_two_writers_of_one_version(spark, monkeypatch):
    t = table(spark, buckets=4)
    t.upsert(frame(spark, [("a", 1)]))
    commit = keyed.PartitionedTable._commit

    def late(self, s, made):
        monkeypatch.setattr(keyed.PartitionedTable, "_commit", commit)
        commit(self, s, made)  # another writer was faster
        commit(self, s, made)

    monkeypatch.setattr(keyed.PartitionedTable, "_commit", late)
    with pytest.raises(keyed.ConcurrentWriteError):
        t.upsert(frame(spark, [("b", 1)]))


def test_new_columns_and_bucket_count(spark):
    t = table(spark)
    t.upsert(frame(spark, [("a", 1), ("b", 2)]))
    t.upsert(frame(spark, [("b", 3)]).withColumn("w", F.lit("x")))
    got = {r.k: (r.v, r.w) for r in t.read(spark).collect()}
    assert got == {"a": (1, None), "b": (3, "x")} and t.version(spark)["buckets"] == keyed.MIN_BUCKETS


def test_buckets_stay_small_and_apart(spark, monkeypatch):
    t = table(spark)
    seen = []
    real = keyed.PartitionedTable._write

    def kept(self, s, listed, out, *rest):
        tasks = out.groupBy(F.spark_partition_id()).agg(F.countDistinct(keyed.BUCKET).alias("n")).collect()
        seen.append(max(r.n for r in tasks))
        real(self, s, listed, out, *rest)

    monkeypatch.setattr(keyed.PartitionedTable, "_write", kept)
    monkeypatch.setattr(keyed, "BUCKET_BYTES", 1 << 10)  # a small stand-in for a large first write
    t.upsert(frame(spark, [(f"key{i}", i) for i in range(20_000)]))
    assert t.version(spark)["buckets"] > keyed.MIN_BUCKETS and seen[0] <= 3
    assert len(rows(t.read(spark))) == 20_000


def test_a_first_write_makes_buckets_that_one_task_holds():
    assert keyed.BUCKET_BYTES <= 8 << 20  # of parquet, unpacked some 30 times that


def test_add_with_retractions(spark):
    t = table(spark, ["u", "d"], bucket_by=["u"], buckets=8)
    df = lambda x: spark.createDataFrame(x, "u string, d string, n long")
    t.add(df([("a", "x", 2), ("a", "x", 1), ("a", "y", 1), (None, "x", 5), (None, None, 1)]), ["n"], "n")
    t.add(df([("a", "x", -3), ("a", "y", 4), (None, "x", -1)]), ["n"], "n")
    assert rows(t.read(spark)) == sorted([("a", "y", 5), (None, "x", 4), (None, None, 1)], key=repr)


def test_replace_groups(spark):
    t = table(spark, ["u", "d"], bucket_by=["u"], buckets=8)
    df = lambda x: spark.createDataFrame(x, "u string, d string, n long")
    start = [(u, d, 1) for u in ("a", "b", "c", None) for d in "pqrstuvw"]
    t.replace_groups(df(start), df(start))
    assert rows(t.read(spark)) == rows(df(start))
    t.replace_groups(df([("a", "p", 2), (None, "z", 3)]), spark.createDataFrame([("a",), ("b",), (None,)], "u string"))
    want = [("a", "p", 2), (None, "z", 3)] + [r for r in start if r[0] == "c"]
    assert rows(t.read(spark)) == rows(df(want))
    t.replace_groups(df([]), df(want))
    assert rows(t.read(spark)) == []


def test_serving_reads_one_bucket_per_request(spark):
    from platewise.plans import lists

    t = keyed.PartitionedTable(work_path(spark, "keyed"), ["user_id"], buckets=64)
    users = [(f"u{i}", f'[{{"id":{i},"name":"d"}}]') for i in range(3000)] + [("default", "[]")]
    t.upsert(spark.createDataFrame(users, "user_id string, gd_dish_types string"))
    one = lists.serve_keyed(spark.createDataFrame([("u7",), ("nobody",), (None,)], "user_id string"), t)
    got = {r.user_id: (r.recommended_items, r.from_default) for r in one.collect()}
    assert got == {"u7": ('[{"id":7,"name":"d"}]', False), "nobody": ("[]", True), None: ("[]", True)}
    assert len([p for p in one.inputFiles() if "/data/" in p]) <= 3
