"""Rule-based anomaly alerts per user over the user's prior history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.columns import T_MS, exact, interval_ms
from eventide.operators._common import SEQ, last_of, only_for_streams, require_time, with_time_seq
from eventide.plans.keyed import HotKeys, keyed, scan, ttl_epochs
from eventide.streaming.ops import WATERMARK

# Fixed values that must equal the reference's (weights, windows, threshold).
RISK_THRESHOLD = 0.7
VELOCITY_WINDOW_MS = 3_600_000      # previous transaction within 1 hour
VELOCITY_MIN_PRIOR = 10             # ... and more than 10 prior transactions
GEO_WINDOW_MS = 7_200_000           # country change within 2 hours
AMOUNT_FACTOR = 5.0                 # amount above 5 x prior mean
MERCHANT_MIN_PRIOR = 5              # more than 5 prior visits to the merchant
SMALL_AMOUNT = 10.0                 # 4 of the last 5 below 10.0
SMALL_LOOKBACK, SMALL_MIN = 5, 4
W_VELOCITY, W_GEO, W_AMOUNT, W_MERCHANT, W_SMALL = 0.3, 0.4, 0.3, 0.2, 0.25
# How long the reference keeps each part of a user's state.
STATE_TTLS = {"history": "30 days", "merchants": "24 hours", "amounts": "7 days"}


def _clocks(state_ttl) -> dict | None:
    """Milliseconds of each part's own TTL, if ``state_ttl`` is a dict of them."""
    if not isinstance(state_ttl, dict):
        return None
    unknown = set(state_ttl) - set(STATE_TTLS)
    if unknown:
        raise ValueError(f"state_ttl: unknown parts {sorted(unknown)}; there are {list(STATE_TTLS)}")
    return {part: interval_ms(state_ttl[part]) if state_ttl.get(part) else None for part in STATE_TTLS}


def anomaly_alerts(df: DataFrame, *, user="userId", amount: str = "amount",
                   country: str = "country", merchant: str = "merchant",
                   time: str = "ts", seq: str | None = None,
                   threshold: float = RISK_THRESHOLD, keep=(),
                   rows_per_chunk: int | None = None,
                   watermark: str | None = WATERMARK, state_ttl=None,
                   stream_order: str = "arrival", hot: HotKeys | None = None,
                   history: DataFrame | None = None) -> DataFrame:
    """Output: user, alertType, riskScore, reason, transactionCount (+ keep).

    Each row is scored against the rows of the same user before it (in
    event-time order, ``seq`` breaking ties); an alert is emitted when the
    score reaches ``threshold``.  ``user`` is one key column or a list.

    ``state_ttl``: an interval is one clock, after a longer silence a user
    starts without history.  A dict gives each part of the state a clock of its
    own, as the reference has it (``STATE_TTLS``): 'history' (count, total,
    last country and time) expires after that much silence of the user,
    'merchants' lets each merchant's visits expire after that much silence of
    the user at that merchant, 'amounts' each of the last amounts at that age.
    A part that the dict does not name never expires.

    On a streaming DataFrame the same call runs a transformWithState
    processor; ``watermark`` bounds lateness and ``stream_order`` is
    'arrival' (fold each micro-batch as it comes) or 'event' (buffer until
    the watermark passes, then fold in event-time order).

    ``history``: on a stream, a batch DataFrame of the input's columns whose
    rows come before all of the stream's: each key starts with the state that
    folding them leaves (computed as a batch job, handed over in the first
    micro-batch).  Totals, last rows and each merchant's visits
    are handed over as rows of their own, so no user's state is ever one row."""
    require_time(time, "anomaly_alerts")
    users = [user] if isinstance(user, str) else list(user)
    d = with_time_seq(df, time, seq, "anomaly_alerts",
                      need=(*users, amount, country, merchant, *keep))
    d = d.select(*dict.fromkeys([*users, amount, country, merchant, T_MS, SEQ, *keep]))
    clocks = _clocks(state_ttl)
    amt, ttl = F.col(amount), interval_ms(state_ttl) if state_ttl and clocks is None else None
    if d.isStreaming:
        from eventide.streaming import ops as st
        extra = [c for c in keep if c not in users]
        if extra and extra != [seq]:
            raise NotImplementedError("streams keep only the seq column")
        rules = {"velocity_ms": VELOCITY_WINDOW_MS, "velocity_min": VELOCITY_MIN_PRIOR,
                 "geo_ms": GEO_WINDOW_MS, "factor": AMOUNT_FACTOR,
                 "merchant_min": MERCHANT_MIN_PRIOR, "small": SMALL_AMOUNT,
                 "lookback": SMALL_LOOKBACK, "small_min": SMALL_MIN, "threshold": threshold,
                 "w": (W_VELOCITY, W_GEO, W_AMOUNT, W_MERCHANT, W_SMALL)}
        s = d.select(*users, amt.cast("double").alias("_amount"),
                     F.col(country).alias("_country"), F.col(merchant).alias("_merchant"),
                     T_MS, SEQ)
        state = None
        if history is not None:
            h = with_time_seq(history, time, seq, "anomaly_alerts (history)", need=(*users, amount, country, merchant))
            h = h.select(*dict.fromkeys([*users, amount, country, merchant, T_MS, SEQ]))
            state = _state(_scanned(h, users, amt, country, merchant, ttl, clocks, rows_per_chunk, hot),
                           users, amt, country, merchant)
        return st.anomaly_alerts(s, users, rules, seq if extra else None, watermark,
                                 stream_order, ttl, clocks, state)
    only_for_streams(history, "anomaly_alerts")
    k = _scanned(d, users, amt, country, merchant, ttl, clocks, rows_per_chunk, hot)
    t = F.col(T_MS)
    lt, n = F.col("_lt"), F.col("_rn") - 1
    listed = F.col("_listed") if clocks else n >= SMALL_LOOKBACK
    rules = [
        (lt.isNotNull() & (t - lt < VELOCITY_WINDOW_MS) & (n > VELOCITY_MIN_PRIOR),
         W_VELOCITY, "HIGH_VELOCITY"),
        (F.col("_lc").isNotNull() & ~F.col("_lc").eqNullSafe(F.col(country))
         & lt.isNotNull() & (t - lt < GEO_WINDOW_MS), W_GEO, "GEO_IMPOSSIBLE"),
        ((n > 0) & (amt > F.col("_tot").cast("double") / n * F.lit(AMOUNT_FACTOR)),
         W_AMOUNT, "AMOUNT_ANOMALY"),
        (F.col("_mrn") - 1 > MERCHANT_MIN_PRIOR, W_MERCHANT, "MERCHANT_FREQUENCY"),
        (listed & (F.col("_small") >= SMALL_MIN), W_SMALL, "SMALL_TXN_PATTERN"),
    ]
    score = F.lit(0.0)
    reasons = []
    for cond, w, name in rules:
        hit = F.coalesce(cond, F.lit(False))
        score = score + F.when(hit, F.lit(float(w))).otherwise(F.lit(0.0))
        reasons.append(F.when(hit, F.lit(name)))
    out = k.result().withColumns({"riskScore": score, "reason": F.concat_ws(",", *reasons)})
    return (out.filter(F.col("riskScore") >= F.lit(float(threshold)))
            .select(*users, F.lit("HIGH_RISK").alias("alertType"), "riskScore", "reason",
                    F.col("_rn").cast("int").alias("transactionCount"),
                    *[c for c in keep if c not in users]))


def _scanned(d, users, amt, country, merchant, ttl, clocks, rows_per_chunk, hot):
    """Each row with what the rules compare it to."""
    k = ttl_epochs(keyed(d, users, [T_MS, SEQ], rows_per_chunk, hot), ttl)
    t = F.col(T_MS)
    k = scan(k, rn="_rn", lags={"_lt": t, "_lc": F.col(country)},
             sums_before={"_tot": exact(amt)},
             recent={"_small": (amt < F.lit(SMALL_AMOUNT), SMALL_LOOKBACK)},
             backs={"_t5": (t, SMALL_LOOKBACK)} if clocks and clocks["amounts"] else None)
    if clocks:
        k = _kept_history(k, t, clocks)
    k = scan(k, by=[merchant], rn="_mrn",
             lags={"_mt": t} if clocks and clocks["merchants"] else None)
    if clocks and clocks["merchants"]:
        k = _kept_visits(k, t, merchant, clocks["merchants"])
    return k


def _state(k, users, amt, country, merchant) -> DataFrame:
    """What a stream starts from: one row per user (``_part`` 0: count, total,
    last row and last amounts) and one per user and merchant (1: visits)."""
    t, order = F.col(T_MS), [T_MS, SEQ]
    back = [f"_b{i}" for i in range(SMALL_LOOKBACK - 1, 0, -1)]
    entry = F.struct(amt.cast("double").alias("amount"), t.alias("t"))
    own = scan(k, backs={b: (entry, int(b[2:])) for b in back})
    epoch = F.col("_epoch") if "_epoch" in k.keys else F.lit(0)
    user = last_of(own, order, n=F.col("_rn").cast("int"), tot=(
        F.col("_tot") + F.coalesce(exact(amt), F.lit(0))).cast("string"), country=F.col(country),
        recent=F.filter(F.array(*[F.col(b) for b in back], entry), lambda x: x.isNotNull()), epoch=epoch)
    visits = k.result().groupBy(*users, merchant).agg(F.max_by(
        F.struct(F.col("_mrn").cast("int").alias("visits"), epoch.alias("_in"), t.alias(T_MS)), F.struct(*order))
        .alias("_last")).select(*users, F.col(merchant).alias("merchant"), "_last.*")
    if "_epoch" in k.keys:      # visits of epochs that expired are gone
        of = user.select(*[F.col(u).alias(f"_u{i}") for i, u in enumerate(users)], "epoch")
        on = F.col("_in") == F.col("epoch")
        for i, u in enumerate(users):
            on = on & F.col(u).eqNullSafe(F.col(f"_u{i}"))
        visits = visits.join(of, on, "left_semi")
    return user.drop("epoch").withColumn("_part", F.lit(0)).unionByName(
        visits.drop("_in").withColumn("_part", F.lit(1)), allowMissingColumns=True)


def _kept_history(k, t, clocks: dict):
    """Counts, totals and the last row as far as they are still kept.  A row
    after too long a silence opens a new stretch; its rows count from that row
    on: row number and (exact) total less those at the opening row."""
    listed = F.col("_rn") > SMALL_LOOKBACK
    if clocks["amounts"]:
        listed = listed & (t - F.col("_t5") <= clocks["amounts"])
    k = k.map(lambda d: d.withColumn("_listed", listed))
    if not clocks["history"]:
        return k
    opens = F.coalesce(t - F.col("_lt") > clocks["history"], F.lit(True))
    k = scan(k.map(lambda d: d.withColumn("_opens", opens)), lasts={"_from": F.when(
        F.col("_opens"), F.struct((F.col("_rn") - 1).alias("n"), F.col("_tot").alias("tot")))})
    return k.map(lambda d: d.withColumns({
        "_lt": F.when(~F.col("_opens"), F.col("_lt")), "_lc": F.when(~F.col("_opens"), F.col("_lc")),
        "_rn": F.col("_rn") - F.col("_from.n"), "_tot": F.col("_tot") - F.col("_from.tot")}))


def _kept_visits(k, t, merchant: str, ttl: int):
    """The merchant's visits since the last silence of the user there."""
    again = F.coalesce(t - F.col("_mt") > ttl, F.lit(True))
    k = k.map(lambda d: d.withColumn("_again", F.when(again, F.col("_mrn") - 1)))
    k = scan(k, by=[merchant], lasts={"_visits0": F.col("_again")})
    return k.map(lambda d: d.withColumn("_mrn", F.col("_mrn") - F.col("_visits0")))
