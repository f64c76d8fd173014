import random

import pytest

from tidemark.operators.snapshots import snapshot_changes

SCHEMA = "snapshot_no int, file_id string, modified_time string, full_path string, change string"


def brute(rows):
    import datetime as dt

    at = lambda t: dt.datetime.fromisoformat(t.replace("Z", "+00:00")) if t else None
    low = dt.datetime.min.replace(tzinfo=dt.timezone.utc)
    state = {}
    for no, f, t, p, _ in rows:
        if no is None or f is None:
            continue
        key = lambda v: (v[0] or low, v[1] is not None, v[1] or "")
        now = (at(t), p)
        cur = state.setdefault(no, {})
        cur[f] = max(cur.get(f, now), now, key=key)
    out, nos = [], sorted(state)
    for a, b in zip(nos, nos[1:]):
        x, y = state[a], state[b]
        out += [(b, f, "added") for f in y if f not in x] + [(b, f, "removed") for f in x if f not in y] + [(b, f, "changed") for f in x if f in y and x[f] != y[f]]
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for no in (2, 3, 5, 9):
        for i in range(40):
            if rng.random() < 0.6:
                for _ in range(rng.choice([1, 1, 2])):
                    d = rng.randrange(1, 3)
                    rows.append((no, f"f{i}", rng.choice([f"2025-01-0{d}T00:00:00Z", f"2025-01-0{d}T03:00:00+03:00", None]), rng.choice(["/a", "/b", "", None]), "clash"))
    rows += [*rows[:10], (None, "x", None, None, ""), (3, None, None, None, "")]
    got = sorted(tuple(r) for r in snapshot_changes(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == brute(rows)


def test_one_or_no_snapshot(spark):
    assert snapshot_changes(spark.createDataFrame([], SCHEMA)).count() == 0
    assert snapshot_changes(spark.createDataFrame([(4, "a", None, None, "")], SCHEMA)).count() == 0
