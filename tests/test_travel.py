"""Travel operators against brute force on small fixtures (boundaries, ties, NULLs)."""

import random
from datetime import datetime, timedelta

import pytest

from ledgerguard.config import DEFAULT_CONFIG
from ledgerguard.operators import travel
from tests.helpers import tx_rows

W = timedelta(minutes=10)
BASE = datetime(2024, 1, 1)


def _rows(seed=7, n=400, users=6):
    rnd = random.Random(seed)
    countries = ["A", "B", "C", None]
    rows = []
    for i in range(n):
        # coarse grid of 30 s steps: exact 10-minute gaps and ties are common
        t = BASE + timedelta(seconds=30 * rnd.randrange(0, 400))
        rows.append((f"t{i:04d}", f"u{rnd.randrange(users)}" if rnd.random() > 0.05 else None,
                     t.strftime("%Y-%m-%d %H:%M:%S"), float(rnd.randrange(1, 300)), "Food",
                     rnd.choice(countries)))
    return rows


def _brute_trailing(rows):
    out = set()
    for (i, u, ts, _, _, c) in rows:
        if u is None or c is None:
            continue
        t = datetime.fromisoformat(ts)
        for (_, u2, ts2, _, _, c2) in rows:
            t2 = datetime.fromisoformat(ts2)
            if u2 == u and c2 is not None and c2 != c and t - W <= t2 <= t:
                out.add(i)
                break
    return out


@pytest.mark.parametrize("slices", [1, 3, 10])
def test_trailing_matches_brute_force(spark, slices):
    rows = _rows()
    cfg = DEFAULT_CONFIG.with_(travel_slices=slices)
    got = {r.transaction_id for r in travel.trailing_travel(tx_rows(spark, rows), cfg).collect()}
    assert got == _brute_trailing(rows)


def _brute_hops(rows):
    by_user = {}
    for r in rows:
        if r[1] is not None:
            by_user.setdefault(r[1], []).append(r)
    out = set()
    for seq in by_user.values():
        seq.sort(key=lambda r: (r[2], r[0]))
        for prev, cur in zip(seq, seq[1:]):
            gap = datetime.fromisoformat(cur[2]) - datetime.fromisoformat(prev[2])
            if prev[5] and cur[5] and prev[5] != cur[5] and gap <= W:
                out.add((cur[0], prev[0]))
    return out


@pytest.mark.parametrize("slices", [1, 10])
def test_hops_match_brute_force(spark, slices):
    rows = _rows(seed=11)
    cfg = DEFAULT_CONFIG.with_(travel_slices=slices)
    got = {(r.transaction_id, r.prev_transaction_id)
           for r in travel.travel_hops(tx_rows(spark, rows), cfg).collect()}
    assert got == _brute_hops(rows)


def _brute_sessions(rows):
    by_user = {}
    for r in rows:
        if r[1] is not None:
            by_user.setdefault(r[1], []).append(r)
    out = set()
    for u, seq in by_user.items():
        seq.sort(key=lambda r: r[2])
        cur = [seq[0]]
        for r in seq[1:]:
            if datetime.fromisoformat(r[2]) <= datetime.fromisoformat(cur[-1][2]) + W:
                cur.append(r)
            else:
                out.add(_session(u, cur)); cur = [r]
        out.add(_session(u, cur))
    return {s for s in out if s[3] > 1}


def _session(u, rs):
    cs = sorted({r[5] for r in rs if r[5] is not None})
    return (u, datetime.fromisoformat(rs[0][2]), len(rs), len(cs), ", ".join(cs))


def test_sessions_match_brute_force_and_spark_session_window(spark):
    from pyspark.sql import functions as F
    rows = _rows(seed=3, n=250)
    tx = tx_rows(spark, rows)
    got = {(r.user_id, r.session_start, r.transactions, len(r.country.split(", ")), r.country)
           for r in travel.impossible_travel_session(tx, DEFAULT_CONFIG).collect()}
    assert got == _brute_sessions(rows)
    # Same sessions as Spark's own session_window (the bucketed plan is a rewrite).
    sw = (tx.where(F.col("user_id").isNotNull())
            .groupBy("user_id", F.session_window("event_time", "10 minutes").alias("s"))
            .agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set("country")).alias("c"))
            .where(F.size("c") > 1))
    assert {(r.user_id, r.s.start, r.n) for r in sw.collect()} == {(g[0], g[1], g[2]) for g in got}


def test_exact_window_boundary_is_inclusive(spark):
    rows = [("a", "u", "2024-01-01 00:00:00", 1.0, "Food", "A"),
            ("b", "u", "2024-01-01 00:10:00", 1.0, "Food", "B"),
            ("c", "u", "2024-01-01 00:20:00.000001", 1.0, "Food", "A")]
    tx = tx_rows(spark, rows)
    assert {r.transaction_id for r in travel.trailing_travel(tx).collect()} == {"b"}
    assert {r.transaction_id for r in travel.travel_hops(tx).collect()} == {"b"}
    sess = travel.impossible_travel_session(tx).collect()
    assert [(r.transactions, r.country) for r in sess] == [(2, "A, B")]


def test_hot_user_spreads_over_slices(spark):
    """A user with most of the rows is split into many (user, slice) groups."""
    from pyspark.sql import functions as F
    from ledgerguard.operators.travel import _sliced_base
    rows = [(f"h{i}", "hot", (BASE + timedelta(seconds=7 * i)).strftime("%Y-%m-%d %H:%M:%S"),
             1.0, "Food", "AB"[i % 2]) for i in range(2000)]
    tx = tx_rows(spark, rows)
    groups = _sliced_base(tx, DEFAULT_CONFIG).groupBy("user_id", "_slice").count()
    assert groups.agg(F.max("count")).first()[0] <= 10  # one minute of activity per group
    assert travel.trailing_travel(tx).count() == 1999
