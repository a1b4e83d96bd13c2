"""Random inputs (nulls, equal times, one hot key) vs a plain sequential
per-key fold written directly from the operator semantics.  Each operator is
run on the plain plan and on the hot-key chunked plan."""

import random
from collections import defaultdict

import pytest

from eventide import operators as ops

SEEDS = [1, 2]
CHUNKS = [0, 4]  # 0: never split keys; 4: split every key above 4 rows


def _events(seed, n=300):
    rnd = random.Random(seed)
    rows = []
    t = 1_700_000_000_000
    for seq in range(n):
        t += rnd.choice([0, 1000, 60_000, 1_800_000, 5_000_000, 40_000_000])
        user = "hot" if rnd.random() < 0.5 else rnd.choice(["a", "b", "c", None])
        rows.append(dict(
            user=user, t=t, seq=seq,
            amount=rnd.choice([1.0, 5.0, 9.5, 20.0, 100.0, 900.0, rnd.uniform(0, 50)]),
            country=rnd.choice(["US", "DE", None]),
            merchant=rnd.choice(["m1", "m2", "m3", None]),
            etype=rnd.choice(["view", "click", "END", None]),
            price=rnd.choice([None, 1.0, 2.5, -3.0, 10.0])))
    return rows


def _df(spark, rows):
    return spark.createDataFrame(
        [(r["user"], r["t"], r["seq"], r["amount"], r["country"], r["merchant"], r["etype"],
          r["price"]) for r in rows],
        "user string, t long, seq long, amount double, country string, merchant string, "
        "etype string, price double")


def _by_key(rows, order=("t", "seq")):
    g = defaultdict(list)
    for r in sorted(rows, key=lambda r: tuple(r[o] for o in order)):
        g[r["user"]].append(r)
    return g


def fold_anomaly(rows):
    out = []
    for user, rs in _by_key(rows).items():
        n, tot, last_c, last_t, seen, hist = 0, 0.0, None, None, defaultdict(int), []
        for r in rs:
            score, why = 0.0, []
            if last_t is not None and r["t"] - last_t < 3_600_000 and n > 10:
                score += 0.3
                why.append("HIGH_VELOCITY")
            if last_c is not None and last_c != r["country"] and last_t is not None \
                    and r["t"] - last_t < 7_200_000:
                score += 0.4
                why.append("GEO_IMPOSSIBLE")
            if n > 0 and r["amount"] > tot / n * 5:
                score += 0.3
                why.append("AMOUNT_ANOMALY")
            if seen[r["merchant"]] > 5:
                score += 0.2
                why.append("MERCHANT_FREQUENCY")
            if len(hist) >= 5 and sum(a < 10.0 for a in hist[-5:]) >= 4:
                score += 0.25
                why.append("SMALL_TXN_PATTERN")
            seen[r["merchant"]] += 1
            hist.append(r["amount"])
            if score >= 0.7:
                out.append((user, round(score, 9), ",".join(why), n + 1, r["seq"]))
            tot += r["amount"]
            n += 1
            last_c, last_t = r["country"], r["t"]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("chunk", CHUNKS)
def test_anomaly_vs_fold(spark, seed, chunk):
    rows = _events(seed)
    got = ops.anomaly_alerts(_df(spark, rows), user="user", time="t", seq="seq",
                             keep=("seq",), rows_per_chunk=chunk).collect()
    got = sorted(((r.user, round(r.riskScore, 9), r.reason, r.transactionCount, r.seq)
                  for r in got), key=str)
    assert got == fold_anomaly(rows)


def fold_sessions(rows, tmo, close):
    out = []
    for user, rs in _by_key(rows).items():
        open_, start, first, cnt = False, None, None, 0
        for i, r in enumerate(rs):
            if not open_ or first is None:  # only null types so far: not open yet
                open_, start, first, cnt = True, r["t"], r["etype"], 1
            else:
                cnt += 1
            if r["etype"] == "END":
                out.append((user, "COMPLETED", r["t"] - start, cnt, first, r["etype"]))
                open_ = False
                continue
            nxt = rs[i + 1]["t"] if i + 1 < len(rs) else None
            if nxt is None or nxt - r["t"] > tmo:
                out.append((user, "TIMEOUT", r["t"] + tmo - start, cnt, first, r["etype"]))
                if close:
                    open_ = False
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("chunk", CHUNKS)
@pytest.mark.parametrize("mode", ["continue", "close"])
def test_sessions_vs_fold(spark, seed, chunk, mode):
    rows = _events(seed)
    got = ops.sessions(_df(spark, rows), 3600, user="user", event_type="etype", time="t",
                       seq="seq", end_event="END", on_timeout=mode,
                       rows_per_chunk=chunk).collect()
    got = sorted((tuple(r) for r in got), key=str)
    assert got == fold_sessions(rows, 3_600_000, mode == "close")


def fold_early_fire(rows, size):
    out = []
    for user, rs in _by_key(rows).items():
        win, cnt, tot = None, 0, 0.0
        for r in rs:
            w = r["t"] - r["t"] % size
            if w != win:
                win, cnt, tot = w, 0, 0.0
            cnt += 1
            tot += r["price"] or 0.0
            out.append((user, w, cnt, round(tot, 6), r["seq"]))
    return sorted(out, key=str)


def fold_hybrid(rows, size, n):
    out = []
    for user, rs in _by_key(rows).items():
        groups = defaultdict(list)
        for r in rs:
            groups[r["t"] - r["t"] % size].append(r)
        for w, g in groups.items():
            for i in range(0, len(g), n):
                part = g[i:i + n]
                out.append((user, w, len(part), round(sum(r["price"] or 0.0 for r in part), 6)))
    return sorted(out, key=str)


def _ms(ts):
    import datetime as dt
    return int(ts.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("chunk", CHUNKS)
def test_windows_vs_fold(spark, seed, chunk):
    rows = _events(seed)
    size = 3_600_000
    df = _df(spark, rows)
    ef = ops.early_fire_window(df, size, key="user", time="t", seq="seq", keep=("seq",),
                               rows_per_chunk=chunk).collect()
    got = sorted(((r.user, _ms(r.window_start), r.num_orders, round(r.total_price, 6), r.seq)
                  for r in ef), key=str)
    assert got == fold_early_fire(rows, size)
    hy = ops.hybrid_window(df, size, 3, key="user", time="t", seq="seq",
                           rows_per_chunk=chunk).collect()
    got = sorted(((r.user, _ms(r.window_start), r.num_orders, round(r.total_price, 6))
                  for r in hy), key=str)
    assert got == fold_hybrid(rows, size, 3)


def fold_spend(rows, threshold):
    out = []
    for user, rs in _by_key(rows).items():
        tot, n = 0.0, 0
        for r in rs:
            tot += r["price"] or 0.0
            n += 1
            if tot >= threshold:
                out.append((user, round(tot, 6), str(r["seq"]), n))
                break
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("chunk", CHUNKS)
def test_spend_vs_fold(spark, seed, chunk):
    rows = _events(seed)
    got = ops.spend_threshold(_df(spark, rows), 12.0, key="user", price="price",
                              order_id="seq", time="t", seq="seq",
                              rows_per_chunk=chunk).collect()
    got = sorted(((r.user, round(r.total_spend, 6), r.crossing_order_id, r.order_count)
                  for r in got), key=str)
    assert got == fold_spend(rows, 12.0)


def fold_first_match(rows):
    out = []
    for user, rs in _by_key(rows, order=("t", "side", "seq")).items():
        lo = lc = first = None
        for r in rs:
            first = first if first is not None else r["side"]
            if r["side"] == 0:
                lo = (r["oid"], r["amount"])
                if lc is not None and lc[0] is not None:
                    out.append((lo[0], user, lo[1], lc[0], lc[1], first, r["t"]))
                    break
            else:
                lc = (r["name"], r["tier"])
                if lo is not None and lo[0] is not None:
                    out.append((lo[0], user, lo[1], lc[0], lc[1], first, r["t"]))
                    break
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("chunk", CHUNKS)
def test_first_match_vs_fold(spark, seed, chunk):
    rnd = random.Random(seed)
    rows = []
    for r in _events(seed):
        side = rnd.choice([0, 1])
        rows.append(dict(r, side=side, oid=rnd.choice(["o1", "o2", None]),
                         name=rnd.choice(["N", None]), tier=rnd.choice(["gold", "std"])))
    orders = spark.createDataFrame(
        [(r["user"], r["oid"], r["amount"], r["t"], r["seq"]) for r in rows if r["side"] == 0],
        "customerId string, orderId string, totalAmount double, t long, seq long")
    cust = spark.createDataFrame(
        [(r["user"], r["name"], "e", r["tier"], r["t"], r["seq"]) for r in rows if r["side"] == 1],
        "customerId string, name string, email string, tier string, t long, seq long")
    got = ops.first_match_join(orders, cust, time="t", order_seq="seq", customer_seq="seq",
                               rows_per_chunk=chunk).collect()
    got = sorted(((r.orderId, r.customerId, r.totalAmount, r.customerName, r.customerTier,
                   0 if r.firstArrival == "ORDER" else 1, r.joinTimestamp) for r in got), key=str)
    assert got == fold_first_match(rows)


def test_row_formatter_patterns_vs_fold(spark):
    rows = _events(3)
    df = _df(spark, rows).select("user", "seq", "country", "merchant")
    got = ops.row_formatter(df, ["user"], order="seq").collect()
    got = sorted(((r.user, r.formatted_row, r.distinct_patterns) for r in got), key=str)
    exp = []
    for user, rs in _by_key(rows, order=("seq",)).items():
        seen = set()
        for r in rs:
            seen.add((r["country"] is None, r["merchant"] is None))
            body = ", ".join(f"{c}={'null' if r[c] is None else r[c]}"
                             for c in ("seq", "country", "merchant"))
            exp.append((user, f"[user={'null' if user is None else user}] => {{{body}}}",
                        len(seen)))
    assert got == sorted(exp, key=str)
