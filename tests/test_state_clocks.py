"""Anomaly alerts whose history, merchant visits and amounts expire by clocks
of their own: batch, split keys and streams against a row-by-row fold."""

import random

import pytest

from eventide import operators as ops
from test_stream_cases import batch, run, stream

ROWS = "r string, userId long, amount double, country string, merchant string, ts long, seq int"
HOUR = 3_600_000
CLOCKS = {"history": "9 hours", "merchants": "5 hours", "amounts": "14 hours"}
KEYS = ["r", "userId"]


def some_rows(n=500):
    rnd, t, rows = random.Random(8), {}, []
    for i in range(n):
        u = (rnd.choice("ab"), rnd.choice([1, 2, None]))
        t[u] = t.get(u, 0) + rnd.choice([60_000, 60_000, 300_000, 600_000, HOUR, 2 * HOUR, 6 * HOUR, 10 * HOUR, 15 * HOUR])
        rows.append((*u, rnd.choice([1.0, 2.0, 9.5, 30.0, 400.0, None]), rnd.choice(["x", "y", None]),
                     rnd.choice(["m", "n", None]), t[u], i))
    return rows


def fold(rows, h, m, a, threshold):
    """One row after the other, each part of the state with its last write."""
    hist, visits, amounts, out = {}, {}, {}, []
    for r, u, amt, c, shop, t, seq in sorted(rows, key=lambda x: (x[5], x[6])):
        k = (r, u)
        n, tot, lc, lt = hist.get(k, (0, 0.0, None, None))
        if lt is not None and h and t - lt > h:
            n, tot, lc, lt = 0, 0.0, None, None
        seen, at = visits.get((k, shop), (0, t))
        if m and t - at > m:
            seen = 0
        live = [x for x in amounts.get(k, []) if not a or t - x[1] <= a]
        score, why = 0.0, []
        if lt is not None and t - lt < HOUR and n > 10:
            score, why = score + 0.3, why + ["HIGH_VELOCITY"]
        if lc is not None and lc != c and t - lt < 2 * HOUR:
            score, why = score + 0.4, why + ["GEO_IMPOSSIBLE"]
        if n and amt is not None and amt > tot / n * 5:
            score, why = score + 0.3, why + ["AMOUNT_ANOMALY"]
        if seen > 5:
            score, why = score + 0.2, why + ["MERCHANT_FREQUENCY"]
        if len(live) >= 5 and sum(x is not None and x < 10 for x, _ in live[-5:]) >= 4:
            score, why = score + 0.25, why + ["SMALL_TXN_PATTERN"]
        if score >= threshold:
            out.append((r, u, "HIGH_RISK", score, ",".join(why), n + 1, seq))
        hist[k] = (n + 1, tot + (amt or 0.0), c, t)
        visits[k, shop] = (seen + 1, t)
        amounts[k] = live + [(amt, t)]
    return sorted(out, key=str)


def args(clocks):
    return dict(user=KEYS, time="ts", seq="seq", keep=("seq",), threshold=0.2, state_ttl=clocks)


def ms(clocks):
    return [int(clocks[p].split()[0]) * HOUR if p in clocks else None for p in ("history", "merchants", "amounts")]


@pytest.mark.parametrize("chunk", [None, 4])
@pytest.mark.parametrize("parts", [(), ("history",), ("merchants",), ("amounts",), tuple(CLOCKS)])
def test_each_part_expires_alone(spark, chunk, parts):
    rows = some_rows()
    df = spark.createDataFrame(rows, ROWS)
    clocks = {p: CLOCKS[p] for p in parts}
    got = batch(ops.anomaly_alerts(df, rows_per_chunk=chunk, **args(clocks)))
    assert got == fold(rows, *ms(clocks), 0.2)
    if parts:
        assert got != fold(rows, None, None, None, 0.2)


def test_clocks_on_streams(spark):
    rows = some_rows(300)
    want = fold(rows, *ms(CLOCKS), 0.2)
    for name in CLOCKS:     # every clock matters here
        assert fold(rows, *ms({p: v for p, v in CLOCKS.items() if p != name}), 0.2) != want
    s, d = stream(spark, rows, ROWS, 1)
    assert run(spark, ops.anomaly_alerts(s, **args(CLOCKS)), d) == want
    byk = sorted(rows, key=lambda r: r[5])
    s, d = stream(spark, byk, ROWS, 4)
    assert run(spark, ops.anomaly_alerts(s, watermark="2 hours", **args(CLOCKS)), d) == want


def test_unknown_part(spark):
    with pytest.raises(ValueError):
        ops.anomaly_alerts(spark.createDataFrame([], ROWS), **args({"amount": "1 hour"}))


def test_sessions_and_audit_by_several_keys(spark):
    rows = [("a", 1, "x", 1000), ("b", 1, "x", 2000), ("a", 1, "LOGOUT", 5000), ("b", 1, "y", 3000), ("a", None, "z", 1)]
    schema = "r string, userId long, eventType string, ts long"
    df = spark.createDataFrame(rows, schema)
    want = [("a", 1, "COMPLETED", 4000, 2, "x", "LOGOUT"), ("a", None, "TIMEOUT", 60_000, 1, "z", "z"),
            ("b", 1, "TIMEOUT", 61_000, 2, "x", "y")]
    for chunk in (0, 1):
        assert batch(ops.sessions(df, 60, user=KEYS, rows_per_chunk=chunk)) == want
    s, d = stream(spark, rows, schema, 1)
    assert run(spark, ops.sessions(s, 60, user=KEYS), d) == want[:1]
    rates = [("a", 1, "+I", 1.0, 1), ("a", 2, "+I", 5.0, 2), ("a", 1, "+U", 2.0, 3), ("a", 2, "-D", 5.0, 4)]
    schema = "r string, userId long, op string, rate double, ts long"
    df = spark.createDataFrame(rates, schema)
    got = batch(ops.changelog_audit(df, key=KEYS, time="ts"))
    assert [(r[:3], r[3] and float(r[3]), r[4] and float(r[4])) for r in got] == [
        (("a", 1, "INSERT"), None, 1.0), (("a", 1, "UPDATE"), 1.0, 2.0),
        (("a", 2, "DELETE"), 5.0, None), (("a", 2, "INSERT"), None, 5.0)]
    s, d = stream(spark, rates, schema, 1)
    assert run(spark, ops.changelog_audit(s, key=KEYS, time="ts"), d) == got
