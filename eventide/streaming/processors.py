"""Stateful processors (``transformWithState``) for streaming inputs.

Each processor folds the rows of one key in (event time, seq) order within a
micro-batch and keeps its state in the state store between batches, like the
reference keeps per-key state between calls.  Rows therefore apply in
arrival order across micro-batches (the reference's behaviour); within a
batch they are sorted.  Timers are event-time timers; a row that arrives
after a pending timer's time (the watermark lagged) first emits what the
timer would have emitted, so results do not depend on trigger timing.
"""

from __future__ import annotations

import heapq
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.stateful_processor import ListState, MapState, ValueState

T, Q = "_t", "_q"


def _sorted(rows):
    return sorted(rows, key=lambda r: (r[T], r[Q]))


def _exact(x) -> Decimal:
    """A money amount with the ten decimals that batch sums use; null is 0."""
    return Decimal(repr(float(x or 0.0))).quantize(Decimal("1e-10"), ROUND_HALF_UP)


def field_names(ddl: str) -> list[str]:
    """Top-level field names of a DDL schema string."""
    names, depth, cur = [], 0, ""
    for ch in ddl + ",":
        if ch == "<":
            depth += 1
        elif ch == ">":
            depth -= 1
        if ch == "," and depth == 0:
            names.append(cur.strip().split(" ")[0])
            cur = ""
        else:
            cur += ch
    return names


# What a timer is for.  Spark keeps one timer for each time of a key.
ROWS, END, CLEAN = 1, 2, 4
# Pending rows are kept by buckets of this many milliseconds.
BUCKET_MS = 1000


class _Processor(StatefulProcessor):
    """Base: named output rows (``names`` is set from the output schema), the
    two row orders and timers by purpose.

    arrival (default): each micro-batch's rows of a key are folded at once,
    sorted by (time, seq).  event (``buffer_fields`` set): rows wait in map
    state, by time bucket, with one event-time timer per bucket at the earliest
    of its rows; when the watermark passes it the bucket's due rows are folded
    in (time, seq) order, so rows arriving in another order than their times
    (within the watermark delay) give the batch result.  A firing reads and
    writes its own bucket only.

    Pending rows, the end of a session or window (``ends``) and the clean-up
    may want the same time.  ``_arm`` and ``_disarm`` keep the purposes of each
    time in map state; Spark's timer goes only when no purpose is left.  A
    firing folds due rows first, then reports what ended by then, then cleans
    up."""

    names: list[str] = []
    buffer_fields: list[str] | None = None
    buffer_schema: str | None = None
    cleanup_ms: int | None = None  # clear a key's state after this much silence
    ttl: int | None = None
    ends = False                   # sets timers of its own

    def silence(self):
        """Milliseconds after which nothing of a silent key's state counts; None is never."""
        return self.ttl

    def _row(self, *values):
        return Row(**dict(zip(self.names, values)))

    def init(self, handle):
        self.h = handle
        self.setup(handle)
        if self.buffer_fields:
            self.buf = handle.getMapState("pending", "bucket long",
                                          f"rows array<struct<{self.buffer_schema}>>")
            self.top = handle.getValueState("top", "bucket long")   # the latest pending bucket
        if self.cleanup_ms:
            self.cleanup = handle.getValueState("cleanup", "at long")
        used = [p for p, on in ((ROWS, self.buffer_fields), (END, self.ends), (CLEAN, self.cleanup_ms)) if on]
        self.only = used[0] if len(used) == 1 else None
        if len(used) > 1:
            self.timers = handle.getMapState("timers", "at long", "purposes int")

    def _arm(self, purpose, t):
        if self.only:
            self.h.registerTimer(t)
            return
        m = self.timers.getValue((t,))[0] if self.timers.containsKey((t,)) else 0
        if not m:
            self.h.registerTimer(t)
        if not m & purpose:
            self.timers.updateValue((t,), (m | purpose,))

    def _disarm(self, purpose, t):
        if self.only:
            self.h.deleteTimer(t)
        elif self.timers.containsKey((t,)):
            m = self.timers.getValue((t,))[0] & ~purpose
            if m:
                self.timers.updateValue((t,), (m,))
            else:
                self.timers.removeKey((t,))
                self.h.deleteTimer(t)

    def _move(self, purpose, old, new):
        """The purpose's timer goes from one time to another; None is none."""
        if old != new:
            if old is not None:
                self._disarm(purpose, old)
            if new is not None:
                self._arm(purpose, new)

    def _schedule_cleanup(self, rows):
        """One clean-up time per key at (newest row time + TTL); a newer
        row moves it.  When it comes the key's state is cleared, so keys
        that fall silent do not keep state forever."""
        if not self.cleanup_ms:
            return
        ts = [r[T] for r in rows if r[T] is not None]
        if not ts:
            return
        at = max(ts) + self.cleanup_ms
        old = self.cleanup.get()[0] if self.cleanup.exists() else None
        if old is None or old < at:
            self._move(CLEAN, old, at)
            self.cleanup.update((at,))

    def _clear_all(self):
        if not self.only:
            for (t,) in list(self.timers.keys()):
                self.h.deleteTimer(t)
        for v in list(vars(self).values()):
            if isinstance(v, (ValueState, ListState, MapState)):
                v.clear()

    def setup(self, handle):
        pass

    def fold(self, key, rows):
        raise NotImplementedError

    def handleInitialState(self, key, initialState, timerValues):
        """A row of the state that a batch job left for the key; nested values come as dicts."""
        self.restore(key, initialState)
        self._schedule_cleanup([initialState])

    def restore(self, key, s):
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues):
        rows = list(rows)
        self._schedule_cleanup(rows)
        if not self.buffer_fields:
            return self.fold(key, rows)
        new = {}
        for r in rows:
            new.setdefault(r[T] // BUCKET_MS, []).append(tuple(r[f] for f in self.buffer_fields))
        for bucket, some in new.items():
            self._keep(bucket, self._pending(bucket), some)
        return iter([])

    def _pending(self, bucket):
        if not self.buf.containsKey((bucket,)):
            return []
        return [tuple(x) for x in self.buf.getValue((bucket,))[0]]

    def _keep(self, bucket, old, new):
        """Add rows to a bucket, whose timer is at its earliest row."""
        ti = self.buffer_fields.index(T)
        first = min((x[ti] for x in old), default=None)
        self._move(ROWS, first, min(x[ti] for x in old + new))
        self.buf.updateValue((bucket,), (old + new,))
        if not self.top.exists() or self.top.get()[0] < bucket:
            self.top.update((bucket,))

    def on_timer(self, key, now):
        """Rows that the passing of time alone emits, up to ``now``."""
        return []

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = expiredTimerInfo.getExpiryTimeInMs()
        why = self.only
        if not why:
            why = self.timers.getValue((now,))[0] if self.timers.containsKey((now,)) else 0
            if why:
                self.timers.removeKey((now,))
        out, upto = [], now if why & END else None
        if why & ROWS:
            watermark = timerValues.getCurrentWatermarkInMs()
            if self.top.get()[0] == now // BUCKET_MS:
                upto = watermark        # all rows before it are folded then
            out += self._drain(key, now, watermark)
        if upto is not None:
            out += self.on_timer(key, upto)
        if why & CLEAN and self.cleanup.exists() and self.cleanup.get()[0] == now:
            self._clear_all()
        return iter(out)

    def _drain(self, key, now, watermark):
        """Fold the rows of the bucket at ``now`` that the watermark has passed."""
        bucket, ti = now // BUCKET_MS, self.buffer_fields.index(T)
        pending = self._pending(bucket)
        rest = [x for x in pending if x[ti] > watermark]
        self.buf.removeKey((bucket,))
        if rest:
            self._keep(bucket, [], rest)
        elif self.top.get()[0] == bucket:
            self.top.clear()
        ready = [Row(**dict(zip(self.buffer_fields, x))) for x in pending if x[ti] <= watermark]
        return self.fold(key, ready) if ready else []

    def close(self):
        pass


class SpendThresholdProcessor(_Processor):
    def __init__(self, threshold, key, order_id):
        self.threshold, self.key, self.order_id = float(threshold), key, order_id

    def setup(self, handle):
        self.st = handle.getValueState("spend", "total string, n int, done boolean")

    def restore(self, key, s):
        self.st.update((s["total"], s["n"], s["done"]))

    def fold(self, key, rows):
        total, n, done = self.st.get() if self.st.exists() else ("0", 0, False)
        total, out = Decimal(total), []
        if not done:
            for r in _sorted(rows):
                total += _exact(r["_price"])
                n += 1
                if float(total) >= self.threshold:
                    done = True
                    out.append(self._row(*key, float(total), None if r[self.order_id] is None
                                   else str(r[self.order_id]), n))
                    break
        self.st.update((str(total), n, done))
        return iter(out)


class EarlyFireProcessor(_Processor):
    def __init__(self, size_ms, by_seq=False):
        self.size, self.by_seq = int(size_ms), by_seq

    def setup(self, handle):
        self.st = handle.getValueState("win", "start long, n int, total string")

    def restore(self, key, s):
        self.st.update((s["start"], s["n"], s["total"]))

    def fold(self, key, rows):
        start, n, total = self.st.get() if self.st.exists() else (None, 0, "0")
        total, out = Decimal(total), []
        for r in sorted(rows, key=lambda r: r[Q]) if self.by_seq else _sorted(rows):
            w = r[T] - r[T] % self.size
            if w != start:
                start, n, total = w, 0, Decimal(0)
            n += 1
            total += _exact(r["_price"])
            out.append(self._row(*key, start, start + self.size, n, float(total), r[Q]))
        self.st.update((start, n, str(total)))
        return iter(out)


class HybridWindowProcessor(_Processor):
    ends = True

    def restore(self, key, s):
        self._save(None, [s["start"], s["n"], s["total"]])

    def __init__(self, size_ms, threshold):
        self.size, self.n = int(size_ms), int(threshold)

    def setup(self, handle):
        self.st = handle.getValueState("win", "start long, n int, total string")

    def _emit(self, key, start, n, total):
        return self._row(*key, start, start + self.size, n, float(total))

    def _load(self):
        start, n, total = self.st.get() if self.st.exists() else (None, 0, "0")
        return [start, n, Decimal(total)]

    def _save(self, old, w):
        self._move(END, *(None if x is None else x + self.size for x in (old, w[0])))
        if w[0] is None:
            self.st.clear()
        else:
            self.st.update((w[0], w[1], str(w[2])))

    def fold(self, key, rows):
        w = self._load()
        old, out = w[0], []
        for r in _sorted(rows):
            win = r[T] - r[T] % self.size
            if w[0] is not None and win != w[0]:
                out.append(self._emit(key, *w))
                w = [None, 0, Decimal(0)]
            if w[0] is None:
                w = [win, 0, Decimal(0)]
            w[1] += 1
            w[2] += _exact(r["_price"])
            if w[1] >= self.n:
                out.append(self._emit(key, *w))
                w = [None, 0, Decimal(0)]
        self._save(old, w)
        return iter(out)

    def on_timer(self, key, now):
        w = self._load()
        if w[0] is None or w[0] + self.size > now:
            return []
        self._disarm(END, w[0] + self.size)
        self.st.clear()
        return [self._emit(key, *w)] if w[1] else []


class SessionProcessor(_Processor):
    ends = True

    def __init__(self, timeout_ms, end_event, close_on_timeout, ttl_ms=None):
        self.tmo, self.end, self.close_tmo = int(timeout_ms), end_event, close_on_timeout
        self.ttl = ttl_ms

    def setup(self, handle):
        self.st = handle.getValueState(
            "session", "start long, first string, last string, n int, timer long, seen long")

    def restore(self, key, s):
        end = s[T] + self.tmo
        self._move(END, None, end)
        self._save([s["start"], s["first"], s["last"], s["n"], end, s[T]])

    def _timeout(self, key, s, at):
        return self._row(*key, "TIMEOUT", at - s[0], s[3], s[1], s[2])

    def _load(self):
        return list(self.st.get()) if self.st.exists() else None

    def _save(self, s):
        if s is None:
            self.st.clear()
        else:
            self.st.update(tuple(s))

    def fold(self, key, rows):
        s = self._load()
        old, out = None if s is None else s[4], []
        for r in _sorted(rows):
            t, et = r[T], r["_type"]
            if s is not None and s[4] is not None and t > s[4]:
                out.append(self._timeout(key, s, s[4]))
                s[4] = None
                if self.close_tmo:
                    s = None
            if self.ttl and s is not None and t - s[5] > self.ttl:
                s = None
            if s is None or s[1] is None:   # also while only null types came
                s = [t, et, et, 1, None, t]
            else:
                s[3] += 1
                s[2] = et
            if et == self.end:
                out.append(self._row(*key, "COMPLETED", t - s[0], s[3], s[1], et))
                s = None
                continue
            s[4], s[5] = t + self.tmo, t
        self._move(END, old, None if s is None else s[4])
        self._save(s)
        return iter(out)

    def on_timer(self, key, now):
        s = self._load()
        if s is None or s[4] is None or s[4] > now:
            return []
        out = [self._timeout(key, s, s[4])]
        self._disarm(END, s[4])
        s[4] = None
        self._save(None if self.close_tmo else s)
        return out


class AuditProcessor(_Processor):
    """Rates travel as strings so DECIMAL values stay exact in state."""

    def __init__(self, ttl_ms=None):
        self.ttl = ttl_ms

    def setup(self, handle):
        self.st = handle.getValueState("rate", "prev string, last long")

    def restore(self, key, s):
        self.st.update((s["prev"], s[T]))

    def fold(self, key, rows):
        prev, last = self.st.get() if self.st.exists() else (None, None)
        out = []
        for r in _sorted(rows):
            op, rate = r["_op"], r["_rate"]
            if self.ttl and last is not None and r[T] - last > self.ttl:
                prev = None
            last = r[T]
            if op == "+I":
                out.append(self._row(*key, "INSERT", None, rate, r["_time"]))
                prev = rate
            elif op == "+U":
                out.append(self._row(*key, "UPDATE", prev, rate, r["_time"]))
                prev = rate
            elif op == "-D":
                out.append(self._row(*key, "DELETE", prev, None, r["_time"]))
                prev = None
        self.st.update((prev, last))
        return iter(out)

class AnomalyProcessor(_Processor):
    """Value state for totals and the last row, map state for merchant visits
    with the time of the last one, list state for the last five rows' amounts
    and times.  ``clocks`` lets each of them expire alone; expired visits are
    swept out once per such period."""

    def __init__(self, rules, ttl_ms=None, clocks=None):
        self.r, self.ttl, self.clocks = rules, ttl_ms, clocks

    def silence(self):
        if self.clocks and all(self.clocks.values()):
            return max(self.clocks.values())
        return self.ttl

    def setup(self, handle):
        self.st = handle.getValueState("user", "n int, tot string, country string, t long, swept long")
        self.merchants = handle.getMapState("merchants", "merchant string", "n int, t long")
        self.recent = handle.getListState("recent", "amount double, t long")

    def restore(self, key, s):
        if s["_part"]:
            self.merchants.updateValue((s["merchant"],), (s["visits"], s[T]))
        else:
            self.st.update((s["n"], s["tot"], s["country"], s[T], None))
            self.recent.put([(x["amount"], x["t"]) for x in s["recent"]])

    def _sweep(self, now):
        for m, (_, t) in list(self.merchants.iterator()):
            if now - t > self.clocks["merchants"]:
                self.merchants.removeKey(m)

    def fold(self, key, rows):
        r_, kept = self.r, self.clocks or {}
        n, tot, lc, lt, swept = self.st.get() if self.st.exists() else (0, "0", None, None, None)
        tot = Decimal(tot)
        recent = [tuple(x) for x in self.recent.get()] if self.recent.exists() else []
        seen_now = {}  # merchant visits read/written once per micro-batch
        out = []
        for r in _sorted(rows):
            t, amt, c, m = r[T], r["_amount"], r["_country"], r["_merchant"]
            if self.ttl and lt is not None and t - lt > self.ttl:
                n, tot, lc, lt, recent = 0, Decimal(0), None, None, []
                seen_now = {}
                self.merchants.clear()
            if kept.get("history") and lt is not None and t - lt > kept["history"]:
                n, tot, lc, lt = 0, Decimal(0), None, None
            if kept.get("amounts"):
                recent = [x for x in recent if t - x[1] <= kept["amounts"]]
            score, why = 0.0, []
            if lt is not None and t - lt < r_["velocity_ms"] and n > r_["velocity_min"]:
                score += r_["w"][0]
                why.append("HIGH_VELOCITY")
            if lc is not None and lc != c and lt is not None and t - lt < r_["geo_ms"]:
                score += r_["w"][1]
                why.append("GEO_IMPOSSIBLE")
            if n > 0 and amt is not None and amt > float(tot) / n * r_["factor"]:
                score += r_["w"][2]
                why.append("AMOUNT_ANOMALY")
            if m not in seen_now:
                mk = (m,)
                seen_now[m] = tuple(self.merchants.getValue(mk)) \
                    if self.merchants.containsKey(mk) else (0, t)
            seen, last = seen_now[m]
            if kept.get("merchants") and t - last > kept["merchants"]:
                seen = 0
            if seen > r_["merchant_min"]:
                score += r_["w"][3]
                why.append("MERCHANT_FREQUENCY")
            seen_now[m] = (seen + 1, t)
            if len(recent) >= r_["lookback"] and sum(
                    1 for a, _ in recent[-r_["lookback"]:] if a is not None and a < r_["small"]) \
                    >= r_["small_min"]:
                score += r_["w"][4]
                why.append("SMALL_TXN_PATTERN")
            recent = (recent + [(amt, t)])[-r_["lookback"]:]
            if score >= r_["threshold"]:
                out.append(self._row(*key, "HIGH_RISK", score, ",".join(why), n + 1, r[Q]))
            tot += _exact(amt)
            n += 1
            lc, lt = c, t
        for m, visits in seen_now.items():
            self.merchants.updateValue((m,), visits)
        if kept.get("merchants") and lt is not None:
            if swept is not None and lt - swept > kept["merchants"]:
                self._sweep(lt)
                swept = lt
            swept = lt if swept is None else swept
        self.st.update((n, str(tot), lc, lt, swept))
        self.recent.put(recent)
        return iter(out)

class FirstMatchProcessor(_Processor):
    EMPTY = [False, None, None, False, None, None, None, None, False, None]

    def __init__(self, ttl_ms=None):
        self.ttl = ttl_ms

    def setup(self, handle):
        self.st = handle.getValueState(
            "match", "has_o boolean, oid string, total double, has_c boolean, name string, "
                     "email string, tier string, first int, done boolean, last long")

    def restore(self, key, s):
        o, c = s["o"], s["c"]
        self.st.update((o is not None, *((o or {}).get(f) for f in ("orderId", "totalAmount")),
                        c is not None, *((c or {}).get(f) for f in ("name", "email", "tier")),
                        s["first"], s["done"], s[T]))

    def fold(self, key, rows):
        s = list(self.st.get()) if self.st.exists() else list(self.EMPTY)
        out = []
        for r in sorted(rows, key=lambda r: (r[T], r["_side"], r[Q])):
            if self.ttl and s[9] is not None and r[T] - s[9] > self.ttl:
                s = list(self.EMPTY)
            s[9] = r[T]
            if s[8]:
                continue
            if s[7] is None:
                s[7] = r["_side"]
            if r["_side"] == 0:
                s[0], s[1], s[2] = True, r["_oid"], r["_total"]
                hit = s[3] and s[4] is not None
            else:
                s[3], s[4], s[5], s[6] = True, r["_name"], r["_email"], r["_tier"]
                hit = s[0] and s[1] is not None
            if hit:
                out.append(self._row(s[1], key[0], s[2], s[4], s[5], s[6],
                               "ORDER" if s[7] == 0 else "CUSTOMER", r[T]))
                s[8] = True
        self.st.update(tuple(s))
        return iter(out)

class PatternCountProcessor(_Processor):
    """Distinct null patterns per key: map state of signatures with the time
    of their last use, and how many there are.  With a TTL a pattern expires
    that long after its last use."""

    def __init__(self, ttl_ms=None):
        self.ttl = ttl_ms

    def setup(self, handle):
        self.seen = handle.getMapState("seen", "sig string", "last long")
        self.count = handle.getValueState("count", "n long")

    def fold(self, key, rows):
        out = []
        rows = sorted(rows, key=lambda r: (r[T] if self.ttl else 0, r["_ord"] is not None, r["_ord"]))
        if self.ttl:
            alive = {k[0]: v[0] for k, v in self.seen.iterator()}
            due = sorted((t, s) for s, t in alive.items())
            heapq.heapify(due)
            for r in rows:
                while due and r[T] - due[0][0] > self.ttl:
                    t, s = heapq.heappop(due)
                    if alive.get(s) == t:
                        del alive[s]
                        self.seen.removeKey((s,))
                alive[r["_sig"]] = r[T]
                heapq.heappush(due, (r[T], r["_sig"]))
                out.append(self._row(*key, r["formatted_row"], r["schema_info"], len(alive)))
            for s in {r["_sig"] for r in rows} & alive.keys():
                self.seen.updateValue((s,), (alive[s],))
            return iter(out)
        n = self.count.get()[0] if self.count.exists() else 0
        known = set()
        for r in rows:
            sig = r["_sig"]
            if sig not in known:
                known.add(sig)
                if not self.seen.containsKey((sig,)):
                    self.seen.updateValue((sig,), (0,))
                    n += 1
            out.append(self._row(*key, r["formatted_row"], r["schema_info"], n))
        self.count.update((n,))
        return iter(out)

class TransactionProcessor(_Processor):
    """Header, counters and line items of one open database transaction."""

    def setup(self, handle):
        self.st = handle.getValueState(
            "txn", "hdr_ord long, hdr_ts long, order_id long, customer_id long, status string, "
                   "total double, received long, expected long, ended boolean")
        self.items = handle.getListState(
            "items", "o long, t long, product_id long, quantity int, unit_price double")

    def fold(self, key, rows):
        s = list(self.st.get()) if self.st.exists() else \
            [None, None, None, None, None, None, 0, None, False]
        new_items = []
        out = []
        for r in sorted(rows, key=lambda r: (r["_side"] == 2, r["_ord"] or 0, r["_ts"] or 0)):
            side = r["_side"]
            if side == 2:
                s[7], s[8] = r["_expected"], True
            else:
                s[6] += 1
                if side == 0 and r["_hdr"] is not None:
                    h = r["_hdr"]
                    if s[0] is None or (r["_ord"], r["_ts"]) >= (s[0], s[1]):
                        s[0], s[1] = r["_ord"], r["_ts"]
                        s[2], s[3], s[4], s[5] = h["id"], h["customer_id"], h["status"], \
                            h["total_amount"]
                if side == 1 and r["_item"] is not None:
                    it = r["_item"]
                    new_items.append((r["_ord"], r["_ts"], it["product_id"], it["quantity"],
                                      it["unit_price"]))
            if s[8] and s[7] is not None and s[6] == s[7]:
                items = sorted(([tuple(x) for x in self.items.get()]
                                if self.items.exists() else []) + new_items,
                               key=lambda x: tuple((v is None, v) for v in x))
                out.append(self._row(key[0], s[2], s[3], s[4], s[5],
                               [Row(product_id=x[2], quantity=x[3], unit_price=x[4])
                                for x in items]))
                self.items.clear()
                new_items = []
                s = [None, None, None, None, None, None, 0, None, False]
        if new_items:
            self.items.appendList(new_items)
        if s[6] or s[8]:
            self.st.update(tuple(s))
        elif self.st.exists():
            self.st.clear()             # an emitted transaction keeps no state
        return iter(out)


class TransactionRowsProcessor(_Processor):
    """The same transaction, emitted as one row per line item.  Items wait in
    map state by pages of ``page_rows``; a micro-batch's rows are taken one
    after the other, and a complete transaction is emitted page by page, so
    that neither is ever held whole."""

    EMPTY = [None, None, None, None, None, None, 0, None, False, 0]

    def __init__(self, page_rows=1000):
        self.page_rows = page_rows

    def setup(self, handle):
        self.st = handle.getValueState(
            "txn", "hdr_ord long, hdr_ts long, order_id long, customer_id long, status string, "
                   "total double, received long, expected long, ended boolean, items long")
        self.pages = handle.getMapState("pages", "page long", "items array<struct<o long,"
                                        "product_id long,quantity int,unit_price double>>")

    def handleInputRows(self, key, rows, timerValues):
        s = list(self.st.get()) if self.st.exists() else list(self.EMPTY)
        tail, ends, newest = None, [], None
        for r in rows:
            if self.cleanup_ms and r[T] is not None and (newest is None or r[T] > newest[T]):
                newest = r
            if r["_side"] == 2:     # after the rows that came with it
                ends.append((r["_ord"] or 0, r["_ts"] or 0, r["_expected"]))
                continue
            s[6] += 1
            h, it = r["_hdr"], r["_item"]
            if r["_side"] == 0 and h is not None and (s[0] is None or (r["_ord"], r["_ts"]) >= (s[0], s[1])):
                s[:6] = r["_ord"], r["_ts"], h["id"], h["customer_id"], h["status"], h["total_amount"]
            if r["_side"] == 1 and it is not None:
                tail = self._add(s, tail, (r["_ord"], it["product_id"], it["quantity"], it["unit_price"]))
            if self._complete(s):
                yield from self._emit(key, s, tail)
                s, tail = list(self.EMPTY), None
        for _, _, expected in sorted(ends, key=lambda e: e[:2]):
            s[7], s[8] = expected, True
            if self._complete(s):
                yield from self._emit(key, s, tail)
                s, tail = list(self.EMPTY), None
        if tail:
            self.pages.updateValue((s[9] // self.page_rows,), (tail,))
        if s[6] or s[8]:
            self.st.update(tuple(s))
        elif self.st.exists():
            self.st.clear()
        if newest is not None:
            self._schedule_cleanup([newest])

    def _complete(self, s):
        return s[8] and s[7] is not None and s[6] == s[7]

    def _add(self, s, tail, item):
        """Append to the last page, which is written when it is full."""
        page, used = divmod(s[9], self.page_rows)
        if tail is None:
            tail = [tuple(x) for x in self.pages.getValue((page,))[0]] if used else []
        tail.append(item)
        s[9] += 1
        if len(tail) == self.page_rows:
            self.pages.updateValue((page,), (tail,))
            tail = []
        return tail

    def _emit(self, key, s, tail):
        full, used = divmod(s[9], self.page_rows)
        if not s[9]:
            yield self._row(key[0], *s[2:6], None, None, None, None)
        for page in range(full + (used > 0)):
            last = page == full and tail is not None
            for x in tail if last else self.pages.getValue((page,))[0]:
                yield self._row(key[0], *s[2:6], *tuple(x))
            if self.pages.containsKey((page,)):
                self.pages.removeKey((page,))


class PricingProcessor(_Processor):
    def __init__(self, inventory_threshold, demand_threshold, min_change, fold_row,
                 ttl_ms=None):
        self.args = (inventory_threshold, demand_threshold, min_change)
        self.fold_row = fold_row
        self.ttl = ttl_ms

    def setup(self, handle):
        self.st = handle.getValueState(
            "price", "price double, inv int, comp double, dem int, last long")

    def fold(self, key, rows):
        state = list(self.st.get()) if self.st.exists() else [None, 0, None, 0, None]
        out = []
        for r in sorted(rows, key=lambda r: (r[T], r["_side"], r[Q])):
            if self.ttl and state[4] is not None and r[T] - state[4] > self.ttl:
                state = [None, 0, None, 0, None]
            state[4] = r[T]
            emitted = self.fold_row(state, r["_side"], r["_qty"], r["_base"], r["_cprice"],
                                    *self.args)
            if emitted is not None:
                out.append(self._row(key[0], emitted[0], emitted[1], emitted[2], r[T], r[Q]))
        self.st.update(tuple(state))
        return iter(out)

    def close(self):
        pass


class LatestChangelogProcessor(_Processor):
    """Changelog of the latest-row-per-key view: the current row is kept in
    value state (with the row's own schema); a row at least as new replaces
    it and emits -U (old row) then +U (new row)."""

    def __init__(self, row_fields, row_ddl):
        self.row_fields, self.row_ddl = row_fields, row_ddl

    def init(self, handle):
        self.st = handle.getValueState("current", "_cur_t long, " + self.row_ddl)

    def handleInputRows(self, key, rows, timerValues):
        cur = tuple(self.st.get()) if self.st.exists() else None
        out = []
        for r in sorted(rows, key=lambda r: r[Q]):
            if cur is not None and cur[0] is not None and (r[T] is None or r[T] < cur[0]):
                continue
            vals = tuple(r[f] for f in self.row_fields)
            if cur is None:
                out.append(self._row("+I", 0, *vals))
            else:
                out.append(self._row("-U", 0, *cur[1:]))
                out.append(self._row("+U", 1, *vals))
            cur = (r[T],) + vals
        if cur is not None:
            self.st.update(cur)
        return iter(out)


class Scd2Processor(_Processor):
    """Versions of a key's rows: value state holds the open one.  A change
    closes it (+U with valid_to); an image opens the next (+I)."""

    def __init__(self, row_fields, row_ddl, time):
        self.row_fields, self.row_ddl, self.time = row_fields, row_ddl, time

    def setup(self, handle):
        self.st = handle.getValueState("current", "_version long, _is_open boolean, " + self.row_ddl)

    def fold(self, key, rows):
        cur = tuple(self.st.get()) if self.st.exists() else (0, False)
        at, out = self.row_fields.index(self.time), []
        for r in sorted(rows, key=lambda r: (r[T] is not None, r[T], r[Q])):
            vals = tuple(r[f] for f in self.row_fields)
            if cur[1]:
                out.append(self._row("+U", 1, cur[0], *cur[2:], cur[2 + at], vals[at]))
            if r["_op"] in ("+I", "+U"):
                cur = (cur[0] + 1, True) + vals
                out.append(self._row("+I", 0, cur[0], *vals, vals[at], None))
            else:
                cur = (cur[0], False) + vals
        self.st.update(cur)
        return iter(out)
