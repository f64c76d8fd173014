import datetime as dt
import os
import random
import shutil
from glob import glob

import pytest
from pyspark.sql import functions as F

from tidemark.operators import incremental as inc

FEED = "feed_seq bigint, run_id int, file_id string, modified_time string, content_text_hash string, extra string"
LOG = "run_id int, status string"


def brute(feed, log):
    good = sorted({r for r, s in log if s and s.strip().lower() == "success"})
    last, out, lo = {}, [], -1
    parse = lambda t: dt.datetime.fromisoformat(t.replace("Z", "+00:00")) if t else dt.datetime.min.replace(tzinfo=dt.timezone.utc)
    for run in good:
        best = {}
        for seq, r, f, t, h, _ in feed:
            if f is not None and lo < r <= run:
                row = (parse(t), seq, (h or "").strip())
                best[f] = max(best.get(f, row), row)
        for f, (t, _, h) in best.items():
            if f not in last:
                case = True
            else:
                t0, h0 = last[f]
                case = t >= t0 and (h != h0 if h and h0 else t > t0)
            if case:
                last[f] = (t, h)
                out.append((run, f))
        lo = run
    return sorted(out)


def random_case(seed):
    rng = random.Random(seed)
    log = [(r, rng.choice(["success", "Success", "failed", None, "SUCCESS"])) for r in range(1, 13)]
    log += rng.sample(log, 3)
    feed = []
    for i in range(400):
        f = "hot" if rng.random() < 0.33 else f"f{rng.randrange(25)}"
        day = rng.randrange(1, 5)
        t = rng.choice([None, "", f"2025-01-0{day}T00:00:00Z", f"2025-01-0{day}T03:00:00.000+03:00"])
        feed.append((i, rng.randrange(1, 14), f, t, rng.choice([None, "", " ", "x", "y", "z"]), "e"))
    feed += [*rng.sample(feed, 20), (999, 3, None, None, "x", "e")]
    return feed, log


def pairs(df):
    return sorted((r["run_id"], r["file_id"]) for r in df.collect())


def frames(spark, feed, log):
    return spark.createDataFrame(feed, FEED), spark.createDataFrame(log, LOG)


@pytest.mark.parametrize("seed", [1, 2])
def test_cases_against_brute_force(spark, seed):
    feed, log = random_case(seed)
    assert pairs(inc.changed_files(*frames(spark, feed, log))) == brute(feed, log)


def test_empty_feed_and_log(spark, tmp_path):
    feed, log = frames(spark, [], [])
    assert inc.changed_files(feed, log).count() == 0
    assert inc.changed_files(spark.createDataFrame([(1, 1, "a", None, None, "")], FEED), log).count() == 0
    assert inc.IncrementalStore(spark, f"file://{tmp_path}/s").published().count() == 0


DAY = "2025-01-01T00:00:00Z"


def test_a_small_change_opens_only_its_leaf(spark, tmp_path):
    feed = [(i, 1, f"f{i}", DAY, "h", "") for i in range(300)]
    store = inc.IncrementalStore(spark, f"file://{tmp_path}/s", per_leaf=1)
    assert store.process(*frames(spark, feed, [(1, "success")])).count() == 300
    levels = store.current()["levels"]
    assert levels == 2 and store.opened > 100
    more = [*feed, (400, 2, "f7", "2025-02-01T00:00:00Z", "new", "")]
    out = store.process(*frames(spark, more, [(1, "success"), (2, "success")]))
    assert [(r["run_id"], r["file_id"], r["op"]) for r in out.collect()] == [(2, "f7", "new")]
    assert store.opened == 1 and store.pages_read == 1
    # the call wrote one page; the tree refers to the first version for all others
    version = store.current()["version"]
    assert len(glob(f"{tmp_path}/s/{version}/pages/leaf=*")) == 1
    assert store.published().count() == 301
    # nothing new: nothing is opened, nothing published
    number = store.current()["number"]
    assert store.process(*frames(spark, random.sample(more, len(more)), [(1, "success"), (2, "success")])).count() == 0
    assert store.opened == 0 and store.current()["number"] == number


def test_late_rows_of_old_runs_are_found_and_nothing_is_repeated(spark, tmp_path):
    feed, log = random_case(9)
    feed = [r for r in feed if r[1] <= 12]
    random.Random(3).shuffle(feed)  # rows come in any order of runs
    store = inc.IncrementalStore(spark, f"file://{tmp_path}/store", per_leaf=40)
    held = {}
    for call, n in enumerate((150, 150, 330, len(feed))):
        out = store.process(*frames(spark, feed[:n], log)).collect()
        for r in out:
            key, row = (r["run_id"], r["file_id"]), (r["at"], r["content"])
            assert (key in held) == (r["op"] != "new")
            held.pop(key) if r["op"] == "withdrawn" else held.update({key: row})
        assert call != 1 or not out
        # a call that dies leaves folders behind, which no one points to
        spark.range(1).write.parquet(f"file://{tmp_path}/store/v-dead{call}/output")
        assert sorted(held) == brute(feed[:n], log) == pairs(store.published())
    store.vacuum()
    assert sorted(held) == pairs(store.published())


def test_a_deeper_tree_takes_over(spark, tmp_path):
    feed = [(i, 1 + i % 3, f"f{i % 60}", DAY, f"h{i}", "") for i in range(200)]
    log = [(r, "success") for r in (1, 2, 3)]
    store = inc.IncrementalStore(spark, f"file://{tmp_path}/s", per_leaf=1)
    store.process(*frames(spark, feed[:10], log))
    first = store.current()["levels"]
    store.process(*frames(spark, feed, log))
    assert store.current()["levels"] > first
    assert pairs(store.published()) == brute(feed, log)


def _damage(how, folder, version):
    tree = glob(f"{folder}/{version}/tree/*.parquet")
    if how == "tree deleted":
        shutil.rmtree(f"{folder}/{version}/tree")
    elif how == "tree changed":
        import pyarrow.parquet as pq

        for f in tree:
            t = pq.read_table(f)
            i = t.schema.get_field_index("digest")
            if len(t):
                pq.write_table(t.set_column(i, t.schema.field(i), t.column(i).combine_chunks().take([*range(len(t))][::-1])), f)
                for crc in glob(os.path.join(os.path.dirname(f), ".*.crc")):
                    os.remove(crc)
    else:
        for d in glob(f"{folder}/{version}/pages/leaf=*"):
            shutil.rmtree(d)


@pytest.mark.parametrize("how", ["tree deleted", "tree changed", "pages deleted"])
def test_what_was_saved_is_checked(spark, tmp_path, how):
    feed = [(i, 1, f"f{i}", DAY, "h", "") for i in range(60)]
    store = inc.IncrementalStore(spark, f"file://{tmp_path}/s", per_leaf=4)
    store.process(*frames(spark, feed, [(1, "success")]))
    _damage(how, f"{tmp_path}/s", store.current()["version"])
    more = [*feed, (99, 2, "f1", "2025-03-01T00:00:00Z", "n", "")]
    with pytest.raises(inc.DamagedStore):
        store.process(*frames(spark, more, [(1, "success"), (2, "success")]))


def test_a_failed_call_is_done_again(spark, tmp_path, monkeypatch):
    feed, log = random_case(4)
    store = inc.IncrementalStore(spark, f"file://{tmp_path}/s")
    f, g = frames(spark, feed, log)
    monkeypatch.setattr(inc.IncrementalStore, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        store.process(f, g)
    monkeypatch.undo()
    assert store.current() is None
    # a pointer that was not written whole does not count, and its number is not used again
    os.makedirs(f"{tmp_path}/s", exist_ok=True)
    with open(f"{tmp_path}/s/pointer-{1:012d}", "w") as torn:
        torn.write('{"version"')
    assert store.current() is None
    assert pairs(store.process(f, g)) == brute(feed, log)
    assert store.current()["number"] == 2
    with pytest.raises(RuntimeError):
        store._publish({"number": 2})


def test_digests_do_not_depend_on_order(spark):
    feed, log = random_case(5)
    trees = []
    for rows in (feed, feed[::-1]):
        leaves = inc.leaf_digests(inc.with_leaf(inc.delivered(*frames(spark, rows, log)), 2))
        trees.append(sorted(inc.grow(leaves, 2).collect()))
    assert trees[0] == trees[1]
    assert inc.broken_nodes(inc.grow(leaves, 2), 2).count() == 0
    assert leaves.agg(F.sum("n_rows")).first()[0] == trees[0][0]["n_rows"]
