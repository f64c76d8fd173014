import random
from collections import Counter

from pyspark.sql import functions as F

from tidemark.functions.common import first_element, is_blank, unblank
from tidemark.operators.hot_keys import heavy_keys, key_profile
from tidemark.operators.skew import hot_keys, split_join


def test_heavy_keys_count_all_rows_and_leave_out_blank(spark):
    rows = [("a;x",)] * 3 + [("b",)] * 1 + [("",)] * 50 + [(None,)] * 40 + [("  ;a",)] * 6
    df = spark.createDataFrame(rows, "parents string")
    got = {r["key_value"]: r["n_rows"] for r in heavy_keys(df, first_element("parents"), 0.03).collect()}
    assert got == {"a": 3}  # 3 of 100 rows is exactly the share


def test_heavy_keys_of_an_empty_table(spark):
    df = spark.createDataFrame([], "parents string")
    assert heavy_keys(df, first_element("parents"), 0.03).count() == 0


def test_profile_against_brute_force_with_one_hot_key(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.4 else rng.choice(["a", "b", None, "c"]), rng.randrange(5), rng.choice([None, 1, 2])) for _ in range(2000)]
    df = spark.createDataFrame(rows, "k string, id int, n int").withColumn("n_rows", F.lit("clash"))
    got = {r["__key"]: (r["n_rows"], r["n_distinct"], r["s"]) for r in key_profile(df.drop("n_rows"), F.col("k"), {"s": F.sum("n")}, F.col("id")).collect()}
    for k, n in Counter(k for k, _, _ in rows).items():
        mine = [r for r in rows if r[0] == k]
        assert got[k] == (n, len({r[1] for r in mine}), sum(r[2] or 0 for r in mine))


def test_split_join_equals_a_join_with_hot_null_and_clashing_columns(spark):
    left = spark.createDataFrame([("h", i, "l") for i in range(300)] + [(None, 1, "l"), ("z", 2, "l")] + [(f"k{i}", i, "l") for i in range(50)], "k string, i int, v string")
    right = spark.createDataFrame([("h", "R"), ("k3", "R3"), (None, "never")], "k string, v string")
    assert hot_keys(left, "k", max_hot=10, least=10) == ["h"]
    for how in ("left", "inner"):
        want = sorted(map(str, left.join(right.withColumnRenamed("v", "v_right"), "k", how).select("k", "i", "v", "v_right").collect()))
        assert sorted(map(str, split_join(left, right, "k", how, hot=["h"]).collect())) == want
        assert sorted(map(str, split_join(left, right, "k", how).collect())) == want
    assert split_join(left.limit(0), right, "k").count() == 0
    assert split_join(left, right.limit(0), "k").count() == left.count()


def test_blanks(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("a",)], "c string")
    assert [r[0] for r in df.select(is_blank("c")).collect()] == [True, True, True, False]
    assert [r[0] for r in df.select(unblank("c")).collect()] == [None, None, None, "a"]
