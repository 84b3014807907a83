"""Structured Streaming operators (ST1-ST5).

The chart scripts update ``var`` state once per closed bar and raise alerts;
here the same per-bar logic runs as stateful streaming queries:

* ST1 ``stream_bars``: ticks -> bars with an event-time watermark (late ticks
  dropped), append mode.
* ST2 ``stream_dedup_alerts``: first alert per (key, hour bucket), a
  watermarked windowed minimum.
* ST3 ``stream_range_events``: live locked-range events with
  ``applyInPandasWithState``; the state is the batch machine's state plus
  the incremental ATR (Wilder) and volume-SMA inputs, so stream and batch
  give the same events.
* ST4 ``stream_regime_alerts``: regime-change and entry alerts from
  incremental SMA-seeded EMAs and Wilder ATR.
  Both take bars as they come or, with a watermark, in the order of their
  times through a reorder buffer in the keyed state.
* ST5 ``ingest_new_files``: exactly-once file ingest (``availableNow``
  trigger + checkpoint).

Sinks and checkpoints live under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import heapq
import json
import math
import uuid
from collections import namedtuple
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from tidemark.operators.ranges import RangeTracker
from tidemark.schemas import INTERVAL_MS
from tidemark.session import ensure_checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:12]}"


def run_available(df: DataFrame, out_path: str, ckpt: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Drive a streaming query over everything available now, then stop."""
    q = (df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", ckpt)
         .option("path", out_path).trigger(availableNow=True).start())
    q.awaitTermination()


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A file stream over one table file of a folder (a file source needs a
    directory; the glob filter picks the table's file)."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
            .option("maxFilesPerTrigger", 1).parquet(sf_dir))


# ------------------------------------------------------------------- ST1

def stream_bars(ticks: DataFrame, every: str = "1h", watermark: str = "10 minutes") -> DataFrame:
    """ST1: streaming ticks (exchange, symbol, ts TIMESTAMP, seq, price, size)
    -> OHLCV bars per tumbling window; late ticks beyond the watermark are
    dropped; a bar is emitted once the watermark passes its end."""
    order = F.struct("ts", "seq")
    g = (ticks.withWatermark("ts", watermark)
         .groupBy("exchange", "symbol", F.window("ts", f"{INTERVAL_MS[every] // 60000} minutes"))
         .agg(F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
              F.max_by("price", order).alias("close"), F.sum("size").alias("volume")))
    ot = F.unix_millis(F.col("window.start"))
    return g.select("exchange", "symbol", F.lit(every).alias("interval"), ot.alias("open_time"),
                    (ot + F.lit(INTERVAL_MS[every] - 1)).alias("close_time"), "open", "high", "low", "close", "volume")


def event_ticks_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream of ticks."""
    ev = table_stream(spark, sf_dir, "events")
    return ev.select(F.lit("EVT").alias("exchange"), F.col("event_type").alias("symbol"),
                     F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"),
                     F.col("value").alias("price"), F.lit(1.0).alias("size"))


# ------------------------------------------------------------------- ST2

def stream_dedup_alerts(alerts: DataFrame, every: str = "1 hour", watermark: str = "2 hours") -> DataFrame:
    """ST2: the first alert, by (ts, id), per (exchange, symbol, signal, source_tf, hour);
    emitted once the watermark passes the hour's end (the same choice as the batch B13)."""
    rest = [c for c in alerts.columns if c not in ("exchange", "symbol", "signal", "source_tf")]
    g = (alerts.withColumn("event_time", F.timestamp_millis("ts")).withWatermark("event_time", watermark)
         .groupBy("exchange", "symbol", "signal", "source_tf", F.window("event_time", every))
         .agg(F.min_by(F.struct(*rest), F.struct("ts", "id")).alias("_a")))
    return g.select("exchange", "symbol", "signal", "source_tf", "_a.*")


# ------------------------------------------------------------------- ST3

RANGE_EVENT_SCHEMA = T.StructType(
    [T.StructField("exchange", T.StringType()), T.StructField("symbol", T.StringType()),
     T.StructField("interval", T.StringType()), T.StructField("bar_idx", T.LongType())]
    + [T.StructField(n, t) for n, t in RangeTracker.event_fields])
STATE_SCHEMA = T.StructType([T.StructField("json", T.StringType())])


class IncrementalInputs:
    """ATR (Wilder, SMA-seeded, n=14) and SMA20 of volume, one bar at a time."""

    def __init__(self, n: int = 14, vol_n: int = 20):
        self.n, self.vol_n = n, vol_n

    def initial(self) -> dict:
        return {"idx": -1, "pc": None, "trs": [], "atr": None, "vols": [], "last_t": None}

    def update(self, s: dict, h: float, lo: float, c: float, v: float) -> tuple[float, float]:
        tr = h - lo if s["pc"] is None else max(h - lo, abs(h - s["pc"]), abs(lo - s["pc"]))
        s["idx"] += 1
        if s["atr"] is None:
            s["trs"].append(tr)
            if len(s["trs"]) == self.n:
                s["atr"] = sum(s["trs"]) / self.n
                s["trs"] = []
        else:
            s["atr"] = s["atr"] + (tr - s["atr"]) / self.n
        s["pc"] = c
        s["vols"] = (s["vols"] + [v])[-self.vol_n:]
        avgv = sum(s["vols"]) / self.vol_n if len(s["vols"]) == self.vol_n else math.nan
        return (s["atr"] if s["atr"] is not None else math.nan), avgv


def _range_machine(machine: RangeTracker):
    """(first state, step): a step takes a key's state and a bar and returns the events."""
    inputs = IncrementalInputs()

    def step(st: dict, r) -> list[dict]:
        t = int(r.open_time)
        if st["i"]["last_t"] is not None and t <= st["i"]["last_t"]:
            return [{"event": "late_bar", "close": float(r.close), "open_time": t}]  # a repeated or late bar changes no state
        st["i"]["last_t"] = t
        atr, avgv = inputs.update(st["i"], float(r.high), float(r.low), float(r.close), float(r.volume))
        row = {"bar_idx": st["i"]["idx"], "open_time": t, "high": float(r.high), "low": float(r.low),
               "close": float(r.close), "volume": float(r.volume), "atr": atr, "avg_volume": avgv}
        return [{"bar_idx": row["bar_idx"], **e} for e in machine.step(st["m"], row)]

    return lambda: {"m": machine.initial(), "i": inputs.initial()}, step


def _frame(key, rows: list[dict], schema: T.StructType) -> pd.DataFrame:
    names = [f.name for f in schema.fields]
    if not rows:
        return pd.DataFrame({n: pd.Series([], dtype=object) for n in names})
    return pd.DataFrame([{"exchange": key[0], "symbol": key[1], "interval": key[2], **r} for r in rows], columns=names)


def _on_arrival(initial, step, schema: T.StructType):
    """State function that takes the bars of a micro-batch in time order, as soon as they come."""
    def fn(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        st = json.loads(state.get[0]) if state.exists else initial()
        batch = pd.concat(list(pdfs), ignore_index=True).sort_values("open_time", kind="stable")
        rows = [e for r in batch.itertuples(index=False) for e in step(st, r)]
        state.update((json.dumps(st, allow_nan=True),))
        yield _frame(key, rows, schema)

    return fn


BAR = namedtuple("BAR", "open_time open high low close volume")
EMIT_ROWS = 10_000


def _in_order(initial, step, schema: T.StructType):
    """State function that holds bars back until the watermark reaches them and takes them in time order.

    The frames of a micro-batch go into a heap one by one; the state holds the machine and the waiting bars: those of the
    watermark's delay and of one micro-batch, which the source's trigger limit bounds, whatever the backlog.  A timer at the first
    waiting bar wakes keys that get no more bars.  Equal times go by their values, so any order of arrival gives the same events; a
    bar behind the watermark (or not after 1970-01-01, where Spark's first watermark stands) is dropped by Spark before it comes here, and one without a time or price is skipped."""
    def fn(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        st = json.loads(state.get[0]) if state.exists else {"machine": initial(), "waiting": []}
        waiting, mark = st["waiting"], state.getCurrentWatermarkMs()
        if not state.hasTimedOut:
            for pdf in pdfs:
                bars = pdf[list(BAR._fields)].dropna(subset=list(BAR._fields[:5])).fillna({"volume": 0.0})
                for t, *values in bars.itertuples(index=False):
                    heapq.heappush(waiting, [int(t), json.dumps([float(v) for v in values])])
        rows = []
        while waiting and waiting[0][0] <= mark:
            t, values = heapq.heappop(waiting)
            rows += step(st["machine"], BAR(t, *json.loads(values)))
            if len(rows) >= EMIT_ROWS:
                yield _frame(key, rows, schema)
                rows = []
        state.update((json.dumps(st, allow_nan=True),))
        if waiting:  # a timer rings when the watermark is past it and has to be ahead of the watermark
            state.setTimeoutTimestamp(max(waiting[0][0] - 1, mark + 1))
        yield _frame(key, rows, schema)

    return fn


def _per_key(bars: DataFrame, machine: tuple, schema: T.StructType, watermark: str | None) -> DataFrame:
    if watermark is None:
        return (bars.groupBy("exchange", "symbol", "interval")
                .applyInPandasWithState(_on_arrival(*machine, schema), schema, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout))
    return (bars.withColumn("event_time", F.timestamp_millis("open_time")).withWatermark("event_time", watermark)
            .groupBy("exchange", "symbol", "interval")
            .applyInPandasWithState(_in_order(*machine, schema), schema, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout))


def stream_range_events(bars: DataFrame, machine: RangeTracker | None = None, watermark: str | None = None) -> DataFrame:
    """ST3: live locked-range events from a bars stream (per key state): activated, breakout_up / _down,
    cancelled, and late_bar for a bar that is not newer than the last one seen.  With a ``watermark`` bars may come in any order
    within its delay: each waits until the watermark reaches its time, and the events are those of the ordered bars."""
    return _per_key(bars, _range_machine(machine or RangeTracker(cancellations=True)), RANGE_EVENT_SCHEMA, watermark)


# ------------------------------------------------------------------- ST4

REGIME_SCHEMA = T.StructType([T.StructField("exchange", T.StringType()), T.StructField("symbol", T.StringType()),
                              T.StructField("interval", T.StringType()), T.StructField("open_time", T.LongType()),
                              T.StructField("alert", T.StringType())])


class RegimeInputs:
    """Swing context of one key (as ``indicators.swing_context`` and ``signals.swing_setups``), one bar at a time."""

    def __init__(self, fast: int = 20, slow: int = 50, slope: int = 5, atr_n: int = 14, atr_sma_n: int = 20):
        self.spans, self.slope, self.atr_sma_n, self.ranges = {"fast": fast, "slow": slow}, slope, atr_sma_n, IncrementalInputs(atr_n)

    def initial(self) -> dict:
        return {"ema": {k: {"value": None, "seed": []} for k in self.spans}, "slow_past": [], "atr": self.ranges.initial(), "atr_past": [],
                "bar": None, "zone": {"long": None, "short": None}, "trend": {"up": False, "down": False}, "last_t": None}

    def smooth(self, e: dict, x: float, n: int) -> float | None:
        if e["value"] is not None:
            e["value"] += 2.0 / (n + 1) * (x - e["value"])
        else:
            e["seed"].append(x)
            if len(e["seed"]) == n:
                e["value"], e["seed"] = sum(e["seed"]) / n, []
        return e["value"]

    def update(self, s: dict, bar) -> list[str]:
        """Advance the state by one bar and name the alerts it raises."""
        o, h, lo, c = (float(x) for x in (bar.open, bar.high, bar.low, bar.close))
        fast, slow = (self.smooth(s["ema"][k], c, n) for k, n in self.spans.items())
        s["slow_past"] = (s["slow_past"] + [slow])[-(self.slope + 1):]
        known = fast is not None and len(s["slow_past"]) > self.slope and s["slow_past"][0] is not None
        rise = slow - s["slow_past"][0] if known else 0.0
        trend = {"up": known and fast > slow and rise > 0, "down": known and fast < slow and rise < 0}
        atr, _ = self.ranges.update(s["atr"], h, lo, c, 0.0)
        s["atr_past"] = (s["atr_past"] + [None if math.isnan(atr) else atr])[-max(self.atr_sma_n, 3):]
        past = s["atr_past"]
        calming = len(past) >= 3 and None not in past[-3:] and past[-1] < past[-2] < past[-3]
        usual = sum(past) / len(past) if len(past) == self.atr_sma_n and None not in past else None
        quiet = usual is not None and past[-1] < usual
        within = {"long": trend["up"] and slow < c < fast, "short": trend["down"] and fast < c < slow}
        for side, extreme, x in (("long", min, lo), ("short", max, h)):
            s["zone"][side] = (x if s["zone"][side] is None else extreme(s["zone"][side], x)) if within[side] else None
        before = s["bar"]
        entry = before is not None and calming and not quiet
        raised = [f"trending_{k}" for k in ("up", "down") if trend[k] and not s["trend"][k]]
        if entry and within["long"] and c > before["high"] and c > o:
            raised.append("long_entry")
        if entry and within["short"] and c < before["low"] and c < o:
            raised.append("short_entry")
        s["bar"], s["trend"] = {"high": h, "low": lo}, trend
        return raised


def _regime_machine():
    inputs = RegimeInputs()

    def step(st: dict, r) -> list[dict]:
        t = int(r.open_time)
        if st["last_t"] is not None and t <= st["last_t"]:
            return [{"open_time": t, "alert": "late_bar"}]
        raised = inputs.update(st, r)
        st["last_t"] = t
        return [{"open_time": t, "alert": a} for a in raised]

    return inputs.initial, step


def stream_regime_alerts(bars: DataFrame, watermark: str | None = None) -> DataFrame:
    """ST4: regime changes and entry alerts (G5) from a bars stream, and late_bar for a bar not newer than the last; ``watermark``
    as in ST3."""
    return _per_key(bars, _regime_machine(), REGIME_SCHEMA, watermark)


# ------------------------------------------------------------------- ST5

def ingest_new_files(spark: SparkSession, src_dir: str, schema: T.StructType, dest: str, ckpt: str,
                     fmt: str = "parquet", glob: str | None = None, **options) -> None:
    """ST5: load every file in ``src_dir`` (optionally matching ``glob``) not
    loaded before (the checkpoint remembers processed files), append to
    ``dest``, stop when caught up."""
    r = spark.readStream.schema(schema).format(fmt).options(**options)
    if glob:
        r = r.option("pathGlobFilter", glob)
    s = r.load(src_dir)
    run_available(s, dest, ckpt)
