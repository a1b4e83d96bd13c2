"""Sessions that end on an end event (COMPLETED) or on inactivity (TIMEOUT),
plus the plain gap-session summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.columns import T_MS, exact, interval_ms
from eventide.operators._common import SEQ, last_of, only_for_streams, require_time, with_time_seq
from eventide.plans.keyed import HotKeys, keyed, scan, ttl_epochs
from eventide.streaming.ops import WATERMARK


def sessions(df: DataFrame, timeout_s, *, user="userId",
             event_type: str = "eventType", time: str = "ts", seq: str | None = None,
             end_event: str = "LOGOUT", on_timeout: str = "continue",
             rows_per_chunk: int | None = None,
             watermark: str | None = WATERMARK, state_ttl=None,
             stream_order: str = "arrival", hot: HotKeys | None = None,
             history: DataFrame | None = None) -> DataFrame:
    """Output: user (one column or a list), status, sessionDuration BIGINT (ms),
    eventCount INT, firstEventType, lastEventType.

    ``timeout_s``: seconds, or an interval such as '30 minutes'.  A session
    opens at a key's first row or after an end event, and opens again at each
    row while only null types came.  A row
    followed by more than ``timeout_s`` of silence emits TIMEOUT with duration
    ``t + timeout - start``.  ``on_timeout='continue'`` (the reference code)
    keeps the session open after a timeout, so counts keep accumulating;
    ``'close'`` starts a new session after it (the documented intent).
    ``state_ttl`` (the reference keeps 2 hours; not below the timeout): after
    a longer silence a user starts over.

    On a streaming DataFrame the same call runs a transformWithState
    processor; ``watermark`` bounds lateness and ``stream_order`` is
    'arrival' (fold each micro-batch as it comes) or 'event' (buffer until
    the watermark passes, then fold in event-time order).

    ``history``: on a stream, a batch DataFrame of the input's columns whose
    rows come before all of the stream's: each key starts with the state that
    folding them leaves (computed as a batch job, handed over in the first
    micro-batch).  A session still open at its end goes on, its timeout
    pending: the stream reports it, not a batch over the history (which shows
    a TIMEOUT after each user's last row)."""
    require_time(time, "sessions")
    if on_timeout not in ("continue", "close"):
        raise ValueError("on_timeout must be 'continue' or 'close'")
    tmo = interval_ms(timeout_s) if isinstance(timeout_s, str) else int(timeout_s * 1000)
    ttl = interval_ms(state_ttl) if state_ttl else None
    if ttl and ttl < tmo:
        raise ValueError("state_ttl must not be below the session timeout")
    users = [user] if isinstance(user, str) else list(user)
    d = with_time_seq(df, time, seq, "sessions", need=(*users, event_type))
    if d.isStreaming:
        from eventide.streaming import ops as st
        state = None
        if history is not None:
            h = with_time_seq(history, time, seq, "sessions (history)", need=(*users, event_type))
            k = _opened(h, users, event_type, tmo, end_event, on_timeout, ttl, rows_per_chunk, hot)
            state = last_of(k, [T_MS, SEQ], start=F.col("_open.t"), first=F.col("_open.e"), last=F.col(event_type),
                            n=(F.col("_rn") - F.col("_open.n") + 1).cast("int"))
            state = state.filter(~F.col("last").eqNullSafe(F.lit(end_event)))
        return st.sessions(d.withColumn("_type", F.col(event_type)), tmo, users, end_event,
                           on_timeout == "close", watermark, stream_order, ttl, state)
    only_for_streams(history, "sessions")
    et, t = F.col(event_type), F.col(T_MS)
    k = _opened(d, users, event_type, tmo, end_event, on_timeout, ttl, rows_per_chunk, hot)
    is_end = et.eqNullSafe(F.lit(end_event))
    is_tmo = ~is_end & (F.col("_nt").isNull() | (F.col("_nt") - t > tmo))
    out = k.result().filter(is_end | is_tmo).withColumns({
        "_cnt": F.col("_rn") - F.col("_open.n") + 1, "_st": F.col("_open.t"),
        "_fe": F.col("_open.e")})
    return out.select(
        *users,
        F.when(is_end, F.lit("COMPLETED")).otherwise(F.lit("TIMEOUT")).alias("status"),
        F.when(is_end, t - F.col("_st")).otherwise(t + tmo - F.col("_st"))
        .cast("long").alias("sessionDuration"),
        F.col("_cnt").cast("int").alias("eventCount"),
        F.col("_fe").alias("firstEventType"),
        et.alias("lastEventType"))


def _opened(d, users, event_type, tmo, end_event, on_timeout, ttl, rows_per_chunk, hot):
    """Each row with its number, the next row's time and its session's opening row."""
    d = d.select(*users, event_type, T_MS, SEQ)
    et, t = F.col(event_type), F.col(T_MS)
    k = ttl_epochs(keyed(d, users, [T_MS, SEQ], rows_per_chunk, hot), ttl)
    k = scan(k, rn="_rn", lags={"_pt": t, "_pe": et}, leads={"_nt": t})
    start = F.col("_pt").isNull() | F.col("_pe").eqNullSafe(F.lit(end_event))
    if on_timeout == "close":
        start = start | (t - F.col("_pt") > tmo)
    # a session whose rows so far all had a null type is not open yet: its next
    # row opens it again
    k = scan(k, lasts={"_s0": F.when(start, F.col("_rn"))},
             lasts_before={"_typed": F.when(et.isNotNull(), F.col("_rn"))})
    start = F.col("_typed").isNull() | (F.col("_typed") < F.col("_s0"))
    # the session's opening row = the last start row so far (row number,
    # time and type travel together); no session id or grouped scan needed
    opening = F.when(start, F.struct(F.col("_rn").alias("n"), t.alias("t"), et.alias("e")))
    return scan(k, lasts={"_open": opening})


def session_summary(df: DataFrame, gap: str, *, user: str = "userId",
                    time: str = "ts", value: str = "eventValue",
                    event_type: str = "eventType", seq: str | None = None, page_rows: int | None = None,
                    watermark: str | None = None, rows_per_chunk: int | None = None,
                    hot: HotKeys | None = None) -> DataFrame:
    """Plain inactivity sessions (documented variant): one row per session with
    sessionStart, sessionEnd (last event + gap), eventCount, totalValue and the
    sorted distinct eventTypes.  Rows without a time belong to no session.

    Batch: a row opens a session when the row before it is ``gap`` or more
    earlier; the running number of openings is the session's number, and
    sessions are aggregated by (user, number), so a user with very many rows
    is spread like in every keyed scan.  Streams use ``session_window``.

    ``page_rows``: eventTypes is every event's type, nulls too, in the order
    (time, ``seq``), in pages of that many: a session of n events has one row
    for each page, numbered by ``page`` from 1, so a session of any length is
    never one row.  A stream keeps an open session's events in its state."""
    if page_rows is not None and page_rows < 1:
        raise ValueError("page_rows must be 1 or more")
    ntz = isinstance(df.schema[time].dataType, T.TimestampNTZType)
    totals = [F.count(F.lit(1)).cast("int").alias("eventCount"),
              F.sum(exact(F.col(value))).cast("double").alias("totalValue")]
    if not page_rows:
        totals.append(F.array_sort(F.collect_set(event_type)).alias("eventTypes"))
    tie = F.col(seq) if seq else F.xxhash64(*[F.col(c) for c in (user, value, event_type, time)])
    if df.isStreaming:  # sessions close when the watermark passes their end
        if ntz:  # watermarks need TIMESTAMP; UTC wall clock either way
            df = df.withColumn(time, F.col(time).cast("timestamp"))
        df = df.withWatermark(time, watermark or WATERMARK)
        bound = (lambda c: c.cast("timestamp_ntz")) if ntz else (lambda c: c)
        window = F.session_window(F.col(time), gap).alias("s")
        head = [user, bound(F.col("s.start")).alias("sessionStart"), bound(F.col("s.end")).alias("sessionEnd"),
                "eventCount", "totalValue"]
        if not page_rows:
            return df.groupBy(user, window).agg(*totals).select(*head, "eventTypes")
        events = F.collect_list(F.struct(F.col(time).alias("t"), tie.alias("q"), F.col(event_type).alias("e")))
        pages = F.transform(F.sequence(F.lit(0), F.ceil(F.size("_events") / page_rows).cast("int") - 1), lambda i: F.struct(
            (i + 1).cast("long").alias("page"),
            F.transform(F.slice("_events", i * page_rows + 1, page_rows), lambda x: x["e"]).alias("eventTypes")))
        return (df.groupBy(user, window).agg(*totals, F.array_sort(events).alias("_events"))
                .select("*", F.explode(pages).alias("_p")).select(*head, "_p.*"))
    us = interval_ms(gap) * 1000
    d = df.filter(F.col(time).isNotNull()).select(
        user, F.col(value), F.col(event_type), F.col(time).alias("_at"),
        F.unix_micros(F.col(time).cast("timestamp")).alias(T_MS), tie.alias(SEQ))
    k = keyed(d, [user], [T_MS, SEQ], rows_per_chunk, hot)
    k = scan(k, lags={"_pt": F.col(T_MS)})
    k = k.map(lambda d: d.withColumn("_new", F.coalesce(
        F.col(T_MS) - F.col("_pt") >= us, F.lit(True)).cast("int")))
    if page_rows:
        return _event_pages(k, user, event_type, value, us, page_rows)
    k = scan(k, sums={"_session": F.col("_new")})
    return (k.result().groupBy(user, "_session")
            .agg(F.min("_at").alias("sessionStart"), F.max("_at").alias("_last"), *totals)
            .select(user, "sessionStart",
                    (F.col("_last") + F.make_dt_interval(secs=F.lit(us / 1e6).cast("decimal(18,6)")))
                    .alias("sessionEnd"), "eventCount", "totalValue", "eventTypes"))


def _event_pages(k, user: str, event_type: str, value: str, gap_us: int, page_rows: int) -> DataFrame:
    """Sessions of a scan with ``_new`` marks, one row per page of events."""
    k = scan(k, rn="_rn", sums={"_session": F.col("_new")})
    k = scan(k, lasts={"_first": F.when(F.col("_new") == 1, F.col("_rn"))})
    event = F.struct(F.col("_rn").alias("n"), F.col(event_type).alias("e"))
    pages = (k.result().withColumn("page", F.floor((F.col("_rn") - F.col("_first")) / page_rows) + 1)
             .groupBy(user, "_session", "page")
             .agg(F.min("_at").alias("_a"), F.max("_at").alias("_b"), F.count(F.lit(1)).alias("_n"),
                  F.sum(exact(F.col(value))).alias("_v"), F.array_sort(F.collect_list(event)).alias("_events")))
    whole = pages.groupBy(F.col(user).alias("_u"), F.col("_session").alias("_s")).agg(
        F.min("_a").alias("sessionStart"),
        (F.max("_b") + F.make_dt_interval(secs=F.lit(gap_us / 1e6).cast("decimal(18,6)"))).alias("sessionEnd"),
        F.sum("_n").cast("int").alias("eventCount"), F.sum("_v").cast("double").alias("totalValue"))
    on = F.col(user).eqNullSafe(F.col("_u")) & (F.col("_session") == F.col("_s"))
    return pages.join(whole, on).select(
        user, "sessionStart", "sessionEnd", "eventCount", "totalValue", "page",
        F.transform("_events", lambda x: x["e"]).alias("eventTypes"))
