import datetime as dt
import itertools
import random

import pytest

from tidemark.operators import references as ref

T0 = dt.datetime(2025, 1, 1)
ITEMS = "file_id string, parents string, trashed boolean, listed_at timestamp, found string"
CORPUS = "file_id string, canonical_file_id string, sieved_at timestamp, gone int"


def day(n):
    return T0 + dt.timedelta(days=n)


def test_reasons(spark):
    items = spark.createDataFrame(
        [
            ("a", "D1", False, day(0), "x"), ("a", "D1;none", None, day(40), "x"), ("a", "D1;none", None, day(40), "x"),
            ("gone", "D1", False, day(0), "x"), ("gone", "D1", True, day(1), "x"),
            ("b", "gone;late; ;", False, day(5), "x"), ("late", "a", False, day(9), "x"), ("dead", "nowhere", True, day(1), "x"), (None, "nowhere", False, day(1), "x"), ("c", None, False, day(1), "x"),
        ],
        ITEMS,
    )
    drives = spark.createDataFrame([("D1",), (None,)], "drive_id string")
    corpus = spark.createDataFrame([("a", " ", day(50), 1), ("b", "gone", day(50), 1), ("late", None, day(2), 1), ("zzz", "D1", None, 1), (None, "a", day(50), 1)], CORPUS)
    got = {tuple(r) for r in ref.broken_references(items, drives, corpus).collect()}
    assert got == {
        ("inventory_items", "2025-02", "a", "none", "missing"), ("inventory_items", "2025-01", "b", "gone", "deleted"), ("inventory_items", "2025-01", "b", "late", "late"),
        ("corpus_rows", "2025-02", "b", "gone", "deleted"), ("corpus_rows", "2025-01", "late", "late", "late"), ("corpus_rows", None, "zzz", "zzz", "missing"),
    }


def test_empty_tables(spark):
    e = lambda s: spark.createDataFrame([], s)
    assert ref.broken_references(e(ITEMS), e("drive_id string"), e(CORPUS)).count() == 0
    assert ref.broken_references(e(ITEMS), e("drive_id string"), spark.createDataFrame([("a", None, T0, 1)], CORPUS)).count() == 1


@pytest.mark.parametrize("match", ["simple", "partial", "full"])
def test_null_masks_against_brute_force(spark, match):
    rng = random.Random(match)
    pick = lambda: rng.choice([None, "x", "y", "z", "w"])
    refs = [(i, pick(), pick(), "extra") for i in range(80)]
    targets = [(pick(), pick()) for _ in range(6)]

    def ok(a, b):
        if a is None and b is None:
            return True
        if (a is None or b is None) and match == "simple":
            return True
        if (a is None or b is None) and match == "full":
            return False
        return any((a is None or a == t[0]) and (b is None or b == t[1]) for t in targets)

    got = ref.orphans(spark.createDataFrame(refs, "id int, a string, b string, gone string"), spark.createDataFrame(targets, "a string, b string"), ["a", "b"], match)
    assert sorted(r["id"] for r in got.collect()) == [i for i, a, b, _ in refs if not ok(a, b)]
    assert list(itertools.chain(got.columns)) == ["id", "a", "b", "gone"]


def test_current_row_is_the_latest(spark):
    rows = [("a", "old", True, day(0), "x"), ("a", "new", None, day(2), "x"), ("a", "new", None, day(2), "x"), ("b", "t", True, day(1), "x"), ("b", "t", False, day(1), "x")]
    got = {r["file_id"]: r for r in ref.current_rows(spark.createDataFrame(rows, ITEMS), "parents").collect()}
    assert (got["a"]["parents"], got["a"]["trashed"], got["a"]["first_listed"]) == ("new", False, day(0))
    assert got["b"]["trashed"] is False  # ties go to the row that is not trashed
