import datetime as dt
import random

import pytest

from tidemark.operators import hierarchy as h

ITEMS = "file_id string, object_kind string, parents string, name string, trashed boolean, listed_at timestamp, node string"
T0 = dt.datetime(2025, 1, 1)


def tree_of(spark, links, drives=("D",), paths=False):
    rows = [(n, "folder", p, f"n{n}", False, T0, "x") for n, p in links] + [("file", "file", "a", "f", False, T0, "x")]
    d = spark.createDataFrame([(x, f"drive {x}") for x in drives], "drive_id string, shared_drive_name string")
    return h.resolve_hierarchy(h.folder_links(spark.createDataFrame(rows, ITEMS), d), paths)


def brute(links, drives):
    up = dict(links)
    first = {n: (p or "").split(";")[0].strip() for n, p in links}
    out = {}
    for n in up:
        at, steps, seen = n, 0, []
        while True:
            if at in seen:
                out[n] = ("CYCLE", -1, -1, int(at == n or n in seen[seen.index(at):]))
                break
            seen.append(at)
            p = first[at]
            if p in drives:
                out[n] = (p, steps + 1, 0, 0)
                break
            if p == "" or p not in up:
                out[n] = (at, steps, 0, 0)
                break
            at, steps = p, steps + 1
    kids = {n: 0 for n in up}
    for n in up:
        if out[n][0] != "CYCLE":
            p = first[n]
            while p in up and p not in drives:
                kids[p] += 1
                p = first[p]
    return {n: (r, d, kids[n] if r != "CYCLE" else -1, c) for n, (r, d, _, c) in out.items()}


def rows(df):
    return {r["file_id"]: (r["root_id"], r["depth"], r["n_below"], r["on_cycle"]) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_forests_with_cycles(spark, seed):
    rng = random.Random(seed)
    names = [f"f{i}" for i in range(60)]
    links = [(n, rng.choice([*names[: i + 1], "D", "", "gone", "D;f1", None, *names[max(0, i - 3) : i]])) for i, n in enumerate(names)]
    assert rows(tree_of(spark, links)) == brute(links, {"D"})


def test_deep_chain_star_and_two_cycles(spark):
    chain = [("c0", "D")] + [(f"c{i}", f"c{i - 1}") for i in range(1, 70)]
    star = [(f"s{i}", "c3") for i in range(40)]
    rings = [("r1", "r2"), ("r2", "r1"), ("tail", "r1"), ("tail2", "tail"), ("self", "self")]
    links = chain + star + rings
    assert rows(tree_of(spark, links)) == brute(links, {"D"})


def test_only_cycles_and_no_rows(spark):
    assert rows(tree_of(spark, [("a", "b"), ("b", "a")])) == {"a": ("CYCLE", -1, -1, 1), "b": ("CYCLE", -1, -1, 1)}
    assert tree_of(spark, []).count() == 0


def test_paths_and_descendants(spark):
    df = tree_of(spark, [("a", "D"), ("b", "a"), ("c", "b"), ("x", None), ("y", "x"), ("l", "l")], paths=True)
    got = {r["file_id"]: r for r in df.collect()}
    assert got["c"]["full_path"] == "/drive D/na/nb/nc" and got["y"]["full_path"] == "/nx/ny" and got["l"]["full_path"] is None
    assert sorted(tuple(r) for r in h.descendants(df).collect()) == [("a", "b", 1), ("a", "c", 2), ("b", "c", 1), ("x", "y", 1)]
