"""Days that arrive in chunks."""

from __future__ import annotations

import datetime as dt
import os

from tidemark.operators.aggregate import month_partials
from tidemark.plans import backfill

SCHEMA = "key string, date date, tmean_c double, prcp_mm double"


def rows(first, n, shift=0.0, keys=("a", "b")):
    start = dt.date.fromisoformat(first)
    return [(k, start + dt.timedelta(days=i), shift + i, 0.5 * i if i % 3 else None) for k in keys for i in range(n)]


def files(root):
    return {os.path.join(p, f): os.stat(os.path.join(p, f)).st_mtime_ns for p, _, fs in os.walk(root) for f in fs if f.startswith("part-")}


def test_chunks_equal_the_whole_and_other_months_stay(spark, frame, tmp_path):
    store = str(tmp_path / "store")
    first, second = rows("2001-01-01", 100), rows("2001-04-05", 60, 7.0)
    assert backfill.append_days(frame(first, SCHEMA), store, ["key"]) == ["2001-01", "2001-02", "2001-03", "2001-04"]
    before = files(store)
    # six days overlap and keep their first values; a repeated row counts once
    assert backfill.append_days(frame(second + second[:1], SCHEMA), store, ["key"]) == ["2001-04", "2001-05", "2001-06"]
    after = files(store)
    kept = {f for f in before if not any(m in f for m in ("2001-04", "2001-05", "2001-06"))}
    assert len(kept) >= 6 and all(after[f] == before[f] for f in kept)

    known = {(k, d) for k, d, *_ in first}
    whole = frame(first + [r for r in second if r[:2] not in known], SCHEMA)
    want = month_partials(whole, ["key"])
    got = backfill.stored_months(spark, store)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert sorted(map(str, backfill.stored_days(spark, store).select(*whole.columns).collect())) == sorted(map(str, whole.collect()))
    assert backfill.append_days(frame([], SCHEMA), store, ["key"]) == [] and files(store) == after


def test_only_touched_months_are_read(spark, frame, tmp_path):
    store = str(tmp_path / "store")
    backfill.append_days(frame(rows("2001-01-01", 150), SCHEMA), store, ["key"])
    for f in files(f"{store}/days/_month=2001-02"):
        with open(f, "wb") as out:
            out.write(b"no Parquet")  # whoever reads it fails
    backfill.append_days(frame(rows("2001-04-20", 30, 1.0), SCHEMA), store, ["key"])
    part = backfill.stored_days(spark, store, "2001-03-10", "2001-05-01")
    assert part.count() == 2 * (31 - 9 + 30)
    assert backfill.stored_months(spark, store).count() == 10
