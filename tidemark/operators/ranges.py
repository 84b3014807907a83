"""Swing points and locked (consolidation) ranges.

The greedy range scan of the reference ("a range starts at the first narrow
bar after the previous range and always lasts ``max_bars`` more bars") is
sequential, but its state at a block boundary is one small integer: how far
into the block the next range may start (0..max_bars).  Each block therefore
computes its exit state for every possible entry state (pandas over the
block's narrow-bar positions only), a per-key fold over the tiny per-block
table picks the real entry state, and the starts are emitted per block.
Exact for any block size, and no key ever needs one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from itertools import accumulate, compress

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import indicators as I
from tidemark.operators import joins as J
from tidemark.operators import series
from tidemark.operators import windows as W
from tidemark.operators.statemachine import Machine, block_scan
from tidemark.operators.touch import first_touch
from tidemark.schemas import KEY

K = list(KEY)


def div(a, b):
    return F.try_divide(a, b)


def swing_points(bars: DataFrame, length: int = 5) -> DataFrame:
    """L1 + L2: strict swing highs/lows with ``length`` complete bars on each
    side; ``confirmed_at`` = bar index + length (when the pivot is known)."""
    d = I.indexed(bars)
    d = series.halo_windows(d, lambda w: {"swing_high": W.strict_local_max("high", w, length, length),
                                          "swing_low": W.strict_local_min("low", w, length, length)},
                            back=length, fwd=length)
    return d.withColumn("pivot_confirmed_at", F.when(F.col("swing_high") | F.col("swing_low"),
                                                     F.col("bar_idx") + length))


def narrow_bars(bars: DataFrame, rule: str = "atr_sma", atr_n: int = 14) -> DataFrame:
    """L3: narrow-bar flag, one of four definitions.

    atr_sma:   high - low < 0.5 * ATR-SMA(14) (strict window; Python script)
    atr_wilder: high - low < 0.8 * ATR-Wilder(14)
    range_sma: high - low < 1.5 * SMA20(high - low)
    body_sma:  SMA20(|close - open|) < 0.5 * ATR-Wilder(14)
    """
    d = I.indexed(bars)
    rng = F.col("high") - F.col("low")
    if rule == "atr_sma":
        d = I.atr_sma(d, atr_n, full=True, out="atr")
        return d.withColumn("is_narrow", F.coalesce(rng < 0.5 * F.col("atr"), F.lit(False)))
    if rule == "atr_wilder":
        d = I.atr_wilder(d, atr_n, "atr")
        return d.withColumn("is_narrow", F.coalesce(rng < 0.8 * F.col("atr"), F.lit(False)))
    if rule == "range_sma":
        d = series.halo_windows(d, lambda w: {"_rs": W.sma(F.col("high") - F.col("low"), w, 20)}, back=20)
        return d.withColumn("is_narrow", F.coalesce(rng < 1.5 * F.col("_rs"), F.lit(False))).drop("_rs")
    if rule == "body_sma":
        d = I.atr_wilder(d, atr_n, "atr")
        d = series.halo_windows(d, lambda w: {"_bs": W.sma(F.abs(F.col("close") - F.col("open")), w, 20)}, back=20)
        return d.withColumn("is_narrow", F.coalesce(F.col("_bs") < 0.5 * F.col("atr"), F.lit(False))).drop("_bs")
    raise ValueError(rule)


# ------------------------------------------------------------- L4 greedy starts

def _chain(narrow: np.ndarray, lo: int, gap: int) -> list[int]:
    out, pos = [], lo
    while True:
        k = np.searchsorted(narrow, pos, side="left")
        if k >= len(narrow):
            return out
        s = int(narrow[k])
        out.append(s)
        pos = s + gap


def range_starts(flags: DataFrame, max_bars: int = 50, key: Sequence[str] = KEY) -> DataFrame:
    """Greedy range starts: the first narrow bar, then the first narrow bar
    after ``start + max_bars``, and so on (one row per start: key, start_idx)."""
    key = list(key)
    b = series.block_rows(flags)
    gap = max_bars + 1
    if b <= gap:
        raise ValueError("block size must exceed max_bars + 1")
    nar = flags.where("is_narrow").select(*key, "bar_idx").withColumn(
        "_blk", F.floor(F.col("bar_idx") / F.lit(b)).cast("long"))
    ktypes = {f.name: f.dataType for f in flags.schema.fields}
    kf = [T.StructField(k, ktypes[k]) for k in key]
    trans_schema = T.StructType(kf + [T.StructField("_blk", T.LongType()),
                                      T.StructField("_exit", T.ArrayType(T.IntegerType()))])

    def transitions(pdf: pd.DataFrame) -> pd.DataFrame:
        blk = int(pdf["_blk"].iloc[0])
        lo0, nxt = blk * b, (blk + 1) * b
        idx = np.sort(pdf["bar_idx"].to_numpy())
        exits = []
        for e in range(gap):
            st = _chain(idx, lo0 + e, gap)
            exits.append(max(0, st[-1] + gap - nxt) if st else 0)
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in key}, "_blk": [blk], "_exit": [exits]})

    trans = nar.groupBy(*key, "_blk").applyInPandas(transitions, trans_schema)
    entry_schema = T.StructType(kf + [T.StructField("_blk", T.LongType()), T.StructField("_entry", T.IntegerType())])

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_blk").reset_index(drop=True)
        state, prev, entries = 0, None, []
        for blk, ex in zip(pdf["_blk"], pdf["_exit"]):
            if prev is not None and blk != prev + 1:
                state = 0  # blocks without narrow bars in between: everything is free again
            entries.append(state)
            state, prev = int(ex[state]), blk
        out = pdf[[*key, "_blk"]].copy()
        out["_entry"] = entries
        return out

    entry = trans.groupBy(*key).applyInPandas(fold, entry_schema)
    start_schema = T.StructType(kf + [T.StructField("start_idx", T.LongType())])

    def starts(pdf: pd.DataFrame) -> pd.DataFrame:
        blk, e = int(pdf["_blk"].iloc[0]), int(pdf["_entry"].iloc[0])
        st = _chain(np.sort(pdf["bar_idx"].to_numpy()), blk * b + e, gap)
        return series.pandas_frame({**{k: [pdf[k].iloc[0]] * len(st) for k in key}, "start_idx": st}, start_schema)

    return J.null_safe_join(nar, entry, [*key, "_blk"]).groupBy(*key, "_blk").applyInPandas(starts, start_schema)


def fixed_ranges(bars: DataFrame, max_bars: int = 50, min_history: int = 20, touch_atr: float = 0.1,
                 threshold: float = 0.15, narrow_rule: str = "atr_sma", swing_len: int = 5,
                 tpsl: Sequence[tuple[str, str]] = (("auto", "second_swing"),), height_mult: float = 1.0) -> DataFrame:
    """L4 + L6 + L7 + L8 + L12 + L13 + L18: the Python range report.

    Every range spans [start, start + max_bars] (the script's break test can
    never fire, see SURVEY §8-1) and is dropped if the history ends first;
    keys with fewer than ``min_history`` bars give none.  Touches: bars after
    the first with high >= running top - touch_atr*ATR (low likewise);
    pressure = volume per touch; imbalance = (buy - sell) / max, 0 when both
    are 0; type Resistance / Support / Gravitation at +/-threshold (strict).
    TPSL1 = nearest swing within 49 bars before the start if beyond the
    range, else one height away; TPSL2 = the second swing within 99 bars.
    """
    d = swing_points(narrow_bars(bars, narrow_rule), swing_len)
    n = d.groupBy(*K).agg(F.max("bar_idx").alias("_last"), F.count(F.lit(1)).alias("_n"))
    st = J.null_safe_join(range_starts(d, max_bars), n, K).where(
        (F.col("_n") >= min_history) & (F.col("start_idx") + max_bars <= F.col("_last"))).drop("_n", "_last")
    # Bars of each range: bounded index-bucket join from the (few) starts.
    inr = J.within_rows(st.withColumnRenamed("start_idx", "rid"), d, K, "rid", 0, max_bars)
    wr = Window.partitionBy(*K, "rid").orderBy("bar_idx").rowsBetween(Window.unboundedPreceding, 0)
    inr = inr.withColumns({"_top": F.max("high").over(wr), "_bot": F.min("low").over(wr)})  # W8, <= 51 rows
    first = F.col("bar_idx") == F.col("rid")
    thr = F.col("atr") * touch_atr
    ht = ~first & (F.col("high") >= F.col("_top") - thr)
    lt = ~first & (F.col("low") <= F.col("_bot") + thr)
    agg = inr.groupBy(*K, "rid").agg(
        F.min("open_time").alias("start_time"), F.max("open_time").alias("end_time"),
        F.min("bar_idx").alias("start_idx"), F.max("bar_idx").alias("end_idx"),
        F.max("high").alias("range_high"), F.min("low").alias("range_low"),
        F.count(F.lit(1)).alias("duration_bars"), F.avg("volume").alias("avg_volume"),
        F.count_if(F.coalesce(ht, F.lit(False))).alias("high_touches"),
        F.count_if(F.coalesce(lt, F.lit(False))).alias("low_touches"),
        F.sum(F.when(ht, F.col("volume")).otherwise(0.0)).alias("_hv"),
        F.sum(F.when(lt, F.col("volume")).otherwise(0.0)).alias("_lv"))
    agg = agg.withColumns({"range_height": F.col("range_high") - F.col("range_low"),
                           "buy_pressure": F.col("_hv") / F.greatest(F.col("high_touches"), F.lit(1)),
                           "sell_pressure": F.col("_lv") / F.greatest(F.col("low_touches"), F.lit(1))})
    agg = agg.withColumn("imbalance", imbalance(F.col("buy_pressure"), F.col("sell_pressure")))
    agg = agg.withColumn("type", range_type(F.col("imbalance"), threshold, inclusive=False)).drop("_hv", "_lv", "rid")
    if len(tpsl) > 1:  # several target rules: one row per range and rule
        agg = series.pinned(agg)
    found = [with_tpsl(agg, d, height_mult=height_mult, method1=m1, method2=m2) for m1, m2 in tpsl]
    if len(tpsl) == 1:
        return found[0]
    named = [f.withColumns({"method1": F.lit(m1), "method2": F.lit(m2)}) for f, (m1, m2) in zip(found, tpsl)]
    return reduce(DataFrame.unionByName, named)


def imbalance(buy: Column, sell: Column) -> Column:
    """(buy - sell) / max(buy, sell); 0 when both are 0."""
    return F.when((buy == 0) & (sell == 0), F.lit(0.0)).otherwise((buy - sell) / F.greatest(buy, sell))


def range_type(imb: Column, threshold: float = 0.15, inclusive: bool = False) -> Column:
    """Resistance above +threshold, Support below -threshold, else
    Gravitation (``inclusive``: >= / <=, the guide's percent rule)."""
    if inclusive:
        return F.when(imb >= threshold, "Resistance").when(imb <= -threshold, "Support").otherwise("Gravitation")
    return F.when(imb > threshold, "Resistance").when(imb < -threshold, "Support").otherwise("Gravitation")


def volume_degree(total_volume: Column, vol_sma20: Column, bars: Column) -> Column:
    """Total / (SMA20(volume) * bars): > 1.5 High, > 0.8 Medium, else Low."""
    r = div(total_volume, vol_sma20 * bars)
    return F.when(r > 1.5, "High").when(r > 0.8, "Medium").otherwise("Low")


def strength_label(imbalance_pct: Column) -> Column:
    """|imbalance| in percent: >= 25 Strong, >= 15 Moderate, else Weak."""
    a = F.abs(imbalance_pct)
    return F.when(a >= 25, "Strong").when(a >= 15, "Moderate").otherwise("Weak")


def tpsl_levels(edge: Column, height: Column, first: Column, second: Column, sign: int, method1: str = "auto",
                method2: str = "second_swing") -> tuple[Column, Column]:
    """The two targets beyond one edge (``sign`` 1: the top, -1: the bottom).

    Target 1: ``auto`` (the nearest swing if it lies beyond the edge, else one height), ``swing`` (the nearest swing
    if there is one, else one height), ``height``.  Target 2: ``second_swing`` (the second swing, or NULL), ``beyond`` (the
    second swing if beyond target 1, else half a height more), ``half`` (half a height more than target 1), ``fixed`` (one and a
    half heights from the edge)."""
    beyond = lambda a, b: (a > b) if sign > 0 else (a < b)
    projected = edge + sign * height
    swing = {"auto": first.isNotNull() & (first != 0) & beyond(first, edge), "swing": first.isNotNull(),
             "height": F.lit(False)}[method1]
    target1 = F.when(swing, first).otherwise(projected)
    half = target1 + sign * height / 2
    target2 = {"second_swing": second, "beyond": F.when(second.isNotNull() & beyond(second, target1), second).otherwise(half),
               "half": half, "fixed": edge + sign * height * 1.5}[method2]
    return target1, target2


def with_tpsl(ranges: DataFrame, swings: DataFrame, near: int = 50, far: int = 100,
              height_mult: float = 1.0, method1: str = "auto", method2: str = "second_swing") -> DataFrame:
    """L12 + L13: TPSL1 and TPSL2 of each range by ``tpsl_levels``.  The nearest
    swing is the last one strictly before the start with index
    > max(0, start - near), the second swing the one before the last with index
    > max(0, start - far).  Swings within ``far`` bars of each start come from a
    bounded index-bucket join; heights count ``height_mult`` times."""
    piv = swings.where(F.col("swing_high") | F.col("swing_low")).select(
        *K, F.col("bar_idx").alias("_pi"), "swing_high", "swing_low", F.col("high").alias("_ph"),
        F.col("low").alias("_pl"))
    st = ranges.select(*K, "start_idx")
    pairs = J.within_rows(st, piv, K, "start_idx", -(far - 1), -1, right_idx="_pi")
    s = F.col("start_idx")
    lo_near, lo_far = F.greatest(F.lit(0), s - near), F.greatest(F.lit(0), s - far)

    def nth(flag, val, lo, k):
        arr = F.sort_array(F.collect_list(F.when(F.col(flag) & (F.col("_pi") > lo), F.struct(
            F.col("_pi").alias("i"), F.col(val).alias("v")))), asc=False)
        return F.get(arr, k)["v"]

    tp = pairs.groupBy(*K, "start_idx").agg(
        nth("swing_high", "_ph", lo_near, 0).alias("_h1"), nth("swing_low", "_pl", lo_near, 0).alias("_l1"),
        nth("swing_high", "_ph", lo_far, 1).alias("_h2"), nth("swing_low", "_pl", lo_far, 1).alias("_l2"))
    r = J.null_safe_join(ranges, tp, [*K, "start_idx"], "left")
    hgt = F.col("range_height") * height_mult
    up1, up2 = tpsl_levels(F.col("range_high"), hgt, F.col("_h1"), F.col("_h2"), 1, method1, method2)
    dn1, dn2 = tpsl_levels(F.col("range_low"), hgt, F.col("_l1"), F.col("_l2"), -1, method1, method2)
    r = r.withColumns({"tpsl1_high": up1, "tpsl1_low": dn1, "tpsl2_high": up2, "tpsl2_low": dn2})
    return r.drop("_h1", "_l1", "_h2", "_l2")


def latest_ranges(ranges: DataFrame, n: int = 5, order: str = "end_idx") -> DataFrame:
    """Keep the latest ``n`` ranges per key (two-stage top-n: per key and
    block of ranges, then per key over at most n rows per block)."""
    blk = F.floor(F.col(order) / F.lit(series.block_rows(ranges))).cast("long")
    r = ranges.withColumn("_b", blk)
    w1 = Window.partitionBy(*K, "_b").orderBy(F.col(order).desc())
    r = r.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= n)
    w2 = Window.partitionBy(*K).orderBy(F.col(order).desc())
    return r.withColumn("recency_rank", F.row_number().over(w2)).where(F.col("recency_rank") <= n).drop("_b", "_r1")


def confluence(ranges: DataFrame) -> DataFrame:
    """Per key in start order, whether a range repeats the previous
    range's type (stacking) or alternates, and the length of the same-type
    run so far."""
    r = series.index_series(ranges.withColumn("open_time", F.col("start_time")), idx="_ri").drop("open_time")
    r = series.halo_windows(r, lambda w: {"prev_type": F.lag("type").over(w)}, back=1, idx="_ri")
    r = r.withColumn("stacking", F.col("type") == F.col("prev_type"))
    r = r.withColumn("_s", F.when(~F.coalesce(F.col("stacking"), F.lit(False)), F.col("_ri")))
    blk = F.floor(F.col("_ri") / F.lit(series.block_rows(r))).cast("long")
    r = J.scan_carry(r, ["_s"], K, ["_ri"], blk, forward=True)
    return r.withColumn("same_type_run", F.col("_ri") - F.col("_s_carried") + 1).drop("_s", "_s_carried", "_ri")


# ------------------------------------------------------------ L5 live ranges



def running_touches(highs: Sequence[float], lows: Sequence[float], tolerance: float) -> tuple[list[bool], list[bool]]:
    """Which bars of a run touch its running top / bottom: within ``tolerance`` x the height so far.
    The first bar, which only sets the edges, touches neither."""
    tops, bottoms = list(accumulate(highs, max)), list(accumulate(lows, min))
    near = [(t - b) * tolerance for t, b in zip(tops, bottoms)]
    return ([False] + [h >= t - x for h, t, x in zip(highs, tops, near)][1:],
            [False] + [lo <= b + x for lo, b, x in zip(lows, bottoms, near)][1:])


class RangeTracker(Machine):
    """L5 as runs and breakouts (with L6 height-% touches, L7, L8 inclusive, L10, L14).

    Its state is the open range, or the bars of the current run of narrow (and gated) bars; a
    run that reached ``max_bars`` past its first bar is forgotten.  As soon as a run has ``min_bars``
    bars and a touch, it becomes the open range (``activated``), with the figures of
    ``range_from_run``.  An open range ends on the first later close beyond an edge by ``break_frac`` of its height
    (``breakout_up`` / ``breakout_down``); the next run can start on the bar after.  With ``cancellations`` the latest
    broken range is watched until a close crosses back from beyond its edge deeper than ``back_pct`` of the
    height (``back_mid_pct`` of the way to the middle for a Gravitation range): event ``cancelled`` (L15)."""

    event_fields = (("event", T.StringType()), ("range_start_idx", T.LongType()), ("range_high", T.DoubleType()),
                    ("range_low", T.DoubleType()), ("range_type", T.StringType()), ("imbalance", T.DoubleType()),
                    ("vol_degree", T.StringType()), ("range_bars", T.LongType()), ("touches_high", T.LongType()),
                    ("touches_low", T.LongType()), ("close", T.DoubleType()), ("open_time", T.LongType()))

    def __init__(self, min_bars: int = 8, max_bars: int = 100, narrow_mult: float = 0.8, touch_pct: float = 10.0,
                 min_imb_pct: float = 15.0, break_frac: float = 0.005, require_htf: bool = False,
                 cancellations: bool = False, back_pct: float = 70.0, back_mid_pct: float = 50.0):
        self.cancellations, self.back_pct, self.back_mid_pct = cancellations, back_pct, back_mid_pct
        self.min_bars, self.max_bars, self.narrow_mult = min_bars, max_bars, narrow_mult
        self.touch, self.min_imb_pct, self.break_frac, self.require_htf = touch_pct / 100.0, min_imb_pct, break_frac, require_htf

    def initial(self) -> dict:
        return {"range": None, "run": []} | ({"watched": None, "up": None, "before": None} if self.cancellations else {})

    def narrow(self, bar: dict) -> bool:
        gate = bool(bar["htf_ok"]) if self.require_htf else True
        return gate and bar["high"] - bar["low"] < bar["atr"] * self.narrow_mult  # false for an unknown ATR

    def range_from_run(self, run: list, avg_volume: float) -> dict | None:
        """The range that a run of (idx, high, low, volume) makes, or None without a touch."""
        idx, highs, lows, volumes = zip(*run)
        at_top, at_bottom = running_touches(highs, lows, self.touch)
        if not any(at_top) and not any(at_bottom):
            return None
        per_touch = [sum(compress(volumes, t)) / sum(t) if any(t) else 0.0 for t in (at_top, at_bottom)]
        pressure = (per_touch[0] - per_touch[1]) / max(per_touch) if max(per_touch) > 0 else 0.0
        kind = "Gravitation" if abs(pressure) * 100 < self.min_imb_pct else "Resistance" if pressure > 0 else "Support"
        usual = avg_volume * len(run)
        busy = sum(volumes) / usual if usual > 0 else math.nan  # an unknown average gives the lowest degree
        degree = next((name for name, over in (("High", 1.5), ("Medium", 0.8)) if busy > over), "Low")
        return {"range_start_idx": idx[0], "range_high": max(highs), "range_low": min(lows), "range_type": kind,
                "imbalance": pressure, "vol_degree": degree, "range_bars": len(run),
                "touches_high": sum(at_top), "touches_low": sum(at_bottom)}

    def step(self, state: dict, row: dict) -> list[dict]:
        bar = {k: float("nan") if row[k] is None else float(row[k]) for k in ("high", "low", "close", "volume", "atr", "avg_volume")}
        bar["htf_ok"] = row.get("htf_ok")
        events = self.cancelled(state, bar, int(row["open_time"])) if self.cancellations else []
        if state["range"] is None:
            state["run"] = state["run"] + [[int(row["bar_idx"]), bar["high"], bar["low"], bar["volume"]]] if self.narrow(bar) else []
            if len(state["run"]) >= self.min_bars:
                state["range"] = self.range_from_run(state["run"], bar["avg_volume"])
            named = "activated" if state["range"] else None
            if named or len(state["run"]) > self.max_bars + 1:
                state["run"] = []
        else:
            named = self.broken(state["range"], bar["close"])
        if named is None:
            return events
        events.append({"event": named, **state["range"], "close": bar["close"], "open_time": int(row["open_time"])})
        if named != "activated":
            if self.cancellations:
                state["watched"], state["up"] = state["range"], named == "breakout_up"
            state["range"] = None
        return events

    def cancelled(self, state: dict, bar: dict, open_time: int) -> list[dict]:
        """Whether this bar's close takes back the watched breakout."""
        broken, before = state["watched"], state["before"]
        state["before"] = close = bar["close"]
        if broken is None or before is None:
            return []
        top, bottom = broken["range_high"], broken["range_low"]
        outside = before > top if state["up"] else before < bottom
        if not outside or not bottom < close < top:
            return []
        if broken["range_type"] == "Gravitation":
            enough = (1 - abs(close - (top + bottom) / 2) / ((top - bottom) / 2)) * 100 > self.back_mid_pct
        else:
            enough = (top - close if state["up"] else close - bottom) / (top - bottom) * 100 > self.back_pct
        if not enough:
            return []
        state["watched"] = None
        return [{"event": "cancelled", **broken, "close": close, "open_time": open_time}]

    def broken(self, open_range: dict, close: float) -> str | None:
        top, bottom = open_range["range_high"], open_range["range_low"]
        beyond = (top - bottom) * self.break_frac
        return "breakout_up" if close > top + beyond else "breakout_down" if close < bottom - beyond else None


def live_ranges(bars: DataFrame, machine: RangeTracker | None = None, halo: int = 2000) -> DataFrame:
    """Range events per key (activated / breakout_up / breakout_down) with
    TPSL levels for activations (nearest swing before the start beyond the
    range, else one height; TPSL2 = TPSL1 + half a height).  A machine with
    ``require_htf`` needs the column ``htf_ok`` (L16) on ``bars``."""
    machine = machine or RangeTracker()
    if machine.require_htf and "htf_ok" not in bars.columns:
        raise ValueError("require_htf needs the column htf_ok (see htf_consolidation)")
    gate = ["htf_ok"] if machine.require_htf else []
    d = I.atr_wilder(I.indexed(bars), 14, "atr")
    d = series.halo_windows(d, lambda w: {"avg_volume": W.sma("volume", w, 20)}, back=20)
    ev = block_scan(d, machine, ["open_time", "high", "low", "close", "volume", "atr", "avg_volume", *gate], halo=halo)
    # nearest pivot strictly before each range start: as-of join of the (few)
    # events against the (few) pivots, ordered by bar index
    sw = swing_points(d.select(*K, "bar_idx", "open_time", "high", "low", "close", "volume"), 5)
    ev = ev.withColumn("_t", F.col("range_start_idx") - 1)
    for flag, col, alias in (("swing_high", "high", "_psh"), ("swing_low", "low", "_psl")):
        piv = sw.where(F.col(flag)).select(*K, F.col("bar_idx").alias("_t"), F.col(col).alias(alias))
        ev = J.asof_backward(ev, piv, on="_t", by=K, right_cols=[alias], grain=1 << 20, prefix="p")
        ev = ev.withColumnRenamed(f"p{alias}", alias).drop("p_t")
    ev = ev.drop("_t")
    hgt = F.col("range_high") - F.col("range_low")
    t1h = F.when(F.col("_psh").isNotNull() & (F.col("_psh") > F.col("range_high")), F.col("_psh")) \
        .otherwise(F.col("range_high") + hgt)
    t1l = F.when(F.col("_psl").isNotNull() & (F.col("_psl") < F.col("range_low")), F.col("_psl")) \
        .otherwise(F.col("range_low") - hgt)
    return ev.withColumns({"tpsl1_high": t1h, "tpsl1_low": t1l, "tpsl2_high": t1h + 0.5 * hgt,
                           "tpsl2_low": t1l - 0.5 * hgt}).drop("_psh", "_psl")


def held_ranges(bars: DataFrame, min_bars: int = 8, max_bars: int = 100, touch: float = 0.1, min_imb_pct: float = 10.0,
                back_pct: float = 70.0) -> DataFrame:
    """L5, the variant that builds a candidate all the time and holds one range until it ends.

    The candidate is the current run of narrow bars (``range_sma``): its running edges and, from its second bar on, the volume per touch of either
    (within ``touch`` x the height so far).  A bar of a run of ``min_bars`` to ``max_bars`` bars that has a touch and volume could confirm a range.  A range
    ends on the first bar, its own included, that closes beyond an edge or, for a Resistance or Support range, comes back more than
    ``back_pct`` % into it (the low from the top, the high from the bottom).  While a range is held nothing is confirmed, so the held ranges are the greedy
    choice among all possible ones, in order: every part is a scan whose blocks compose, and no machine runs bar by bar.

    (key, range_start_idx, confirm_idx, range_high, range_low, range_type, imbalance, touches_high, touches_low, end_idx, end_kind): ``end_kind`` is
    breakout_up, breakout_down or cancelled, NULL while the range is held."""
    from tidemark.operators.outcomes import non_overlapping
    d = narrow_bars(bars, "range_sma")
    d = series.halo_windows(d, lambda w: {"_s": F.when(F.col("is_narrow") & ~F.coalesce(F.lag("is_narrow").over(w), F.lit(False)), F.col("bar_idx"))}, back=1)
    d = J.scan_carry(d, ["_s"], K, ["bar_idx"], F.floor(F.col("bar_idx") / F.lit(series.block_rows(d))).cast("long"))
    run = d.where("is_narrow").withColumnRenamed("_s_carried", "range_start_idx")
    run = series.segment_runs(run, [("high", "range_high", "max"), ("low", "range_low", "min")], "range_start_idx")
    near, later = (F.col("range_high") - F.col("range_low")) * touch, F.col("bar_idx") > F.col("range_start_idx")
    at_top, at_bottom = later & (F.col("high") >= F.col("range_high") - near), later & (F.col("low") <= F.col("range_low") + near)
    run = run.withColumns({"_nt": F.when(at_top, 1).otherwise(0).cast("long"), "_vt": F.when(at_top, F.col("volume")).otherwise(0.0),
                           "_nb": F.when(at_bottom, 1).otherwise(0).cast("long"), "_vb": F.when(at_bottom, F.col("volume")).otherwise(0.0)})
    run = series.segment_runs(run, [("_nt", "touches_high", "sum"), ("_vt", "_sum_t", "sum"), ("_nb", "touches_low", "sum"), ("_vb", "_sum_b", "sum")], "range_start_idx")
    top, bottom = (F.when(F.col(n) > 0, F.col(v) / F.col(n)).otherwise(0.0) for n, v in (("touches_high", "_sum_t"), ("touches_low", "_sum_b")))
    most = F.greatest(top, bottom)
    run = run.withColumns({"imbalance": F.try_divide(top - bottom, most), "_bars": F.col("bar_idx") - F.col("range_start_idx") + 1})
    run = run.where(F.col("_bars").between(min_bars, max_bars) & (most > 0))
    kind = F.when(F.col("imbalance") * 100 > min_imb_pct, "Resistance").when(F.col("imbalance") * 100 < -min_imb_pct, "Support").otherwise("Gravitation")
    could = series.pinned(run.select(*K, "range_start_idx", F.col("bar_idx").alias("confirm_idx"), "range_high", "range_low", kind.alias("range_type"),
                                     "imbalance", "touches_high", "touches_low"))
    b, size = series.pinned(d.select(*K, "bar_idx", "high", "low", "close")), (F.col("range_high") - F.col("range_low")) * (back_pct / 100.0)
    ways = (("Resistance", F.col("range_high"), F.col("range_high") - size, "close", "low"), ("Support", F.col("range_low") + size, F.col("range_low"), "high", "close"),
            ("Gravitation", F.col("range_high"), F.col("range_low"), "close", "close"))
    ends = []
    for name, up, down, high, low in ways:
        t = first_touch(could.where(F.col("range_type") == name), b, K, "confirm_idx", up, down, high=high, low=low, strict=True)
        ends.append(t.withColumn("_close", F.col("_hit_high" if high == "close" else "_hit_low")).drop("_hit_high", "_hit_low"))
    t = reduce(DataFrame.unionByName, ends)
    ended = F.when(F.col("_close") > F.col("range_high"), "breakout_up").when(F.col("_close") < F.col("range_low"), "breakout_down").otherwise("cancelled")
    t = t.withColumn("end_kind", F.when(F.col("_hit").isNotNull(), ended)).withColumnRenamed("_hit", "end_idx").drop("_close")
    t = t.withColumn("_end", F.coalesce("end_idx", F.lit(1 << 62)))
    return non_overlapping(t, K, "confirm_idx", "_end", ["confirm_idx"], span=1 << 16).drop("_end")


def range_breakouts(ranges: DataFrame, bars: DataFrame, break_frac: float = 0.005) -> DataFrame:
    """L14 for ranges that are known (``fixed_ranges``): the first close after each range's end that is beyond an edge by
    ``break_frac`` of its height, however late.  Rows are events like those of ``live_ranges`` (event, bar_idx, open_time, close), the
    ranges' other columns stay; ranges that are never left have no row."""
    d = I.indexed(bars).select(*K, "bar_idx", "open_time", "close")
    beyond = (F.col("range_high") - F.col("range_low")) * break_frac
    r = ranges.withColumnsRenamed({"type": "range_type", "start_idx": "range_start_idx"}).withColumn("_from", F.col("end_idx") + 1)
    hit = first_touch(r, d, K, "_from", F.col("range_high") + beyond, F.col("range_low") - beyond, high="close", low="close", strict=True)
    hit = hit.where("_hit IS NOT NULL").withColumnRenamed("_hit", "bar_idx").withColumnRenamed("_hit_high", "close").drop("_from", "_hit_low")
    hit = hit.withColumn("event", F.when(F.col("close") > F.col("range_high"), "breakout_up").otherwise("breakout_down"))
    return J.null_safe_join(hit, d.select(*K, "bar_idx", "open_time"), [*K, "bar_idx"])


def range_activations(ranges: DataFrame) -> DataFrame:
    """The ends of known ranges as ``activated`` events."""
    r = ranges.withColumnsRenamed({"type": "range_type", "start_idx": "range_start_idx"})
    return r.withColumns({"event": F.lit("activated"), "bar_idx": F.col("end_idx"), "open_time": F.col("end_time")})


def breakout_cancellation(events: DataFrame, bars: DataFrame, directional_pct: float = 70.0,
                          gravitation_pct: float = 50.0, crossing: bool = True) -> DataFrame:
    """After a breakout, the first bar whose close returns into the range
    by more than the threshold (% of height): Resistance/Support > 70 %,
    Gravitation > 50 % (measured from the broken edge; for Gravitation as depth
    towards the middle).  ``crossing``: the close of the bar before must be
    beyond the broken edge.  The test stays open until the key's last bar."""
    b = series.halo_windows(I.indexed(bars).select(*K, "bar_idx", "close"), lambda w: {"_pc": F.lag("close").over(w)}, back=1)
    b = b.select(*K, F.col("bar_idx").alias("_bi"), F.col("close").alias("_c"), "_pc")
    br = events.where(F.col("event").startswith("breakout"))
    hgt = F.col("range_high") - F.col("range_low")
    up = F.col("event") == "breakout_up"
    inside = (F.col("_c") < F.col("range_high")) & (F.col("_c") > F.col("range_low"))
    ret_dir = F.when(up, (F.col("range_high") - F.col("_c")) / hgt).otherwise((F.col("_c") - F.col("range_low")) / hgt)
    mid = (F.col("range_high") + F.col("range_low")) / 2
    ret_grav = 1.0 - F.abs(F.col("_c") - mid) / (hgt / 2)
    grav = F.col("range_type") == "Gravitation"
    back = F.when(grav, ret_grav * 100 > gravitation_pct).otherwise(ret_dir * 100 > directional_pct) & inside
    if crossing:
        back = back & F.when(up, F.col("_pc") > F.col("range_high")).otherwise(F.col("_pc") < F.col("range_low"))
    who = [*K, "bar_idx", *[c for c in ("range_start_idx",) if c in br.columns]]
    hit = J.first_bar_where(br, b, K, "bar_idx", back, also=who[len(K) + 1:])
    return (J.null_safe_join(br, hit.select(*who, F.col("_hit").alias("cancel_idx")), who, "left")
            .withColumn("cancelled", F.col("cancel_idx").isNotNull()))


def htf_consolidation(bars: DataFrame, htf: str = "4h", n: int = 20, mult: float = 1.2) -> DataFrame:
    """Attach ``htf_ok`` = the latest *completed* higher-timeframe bar's
    range < mult * SMA_n(HTF range) (T9 resample + J3 as-of on close time)."""
    from tidemark.operators.bars import resample_bars
    hb = I.indexed(resample_bars(bars, htf).withColumn("interval", F.col("source_interval")))  # one series per source interval
    hb = series.halo_windows(hb, lambda w: {"_rs": W.sma(F.col("high") - F.col("low"), w, n)}, back=n)
    right = hb.select(*K, (F.col("close_time") + 1).alias("open_time"),
                      ((F.col("high") - F.col("low")) < mult * F.col("_rs")).alias("htf_ok"))
    out = J.asof_backward(bars, right, on="open_time", by=K, right_cols=["htf_ok"], prefix="h_")
    return out.withColumn("htf_ok", F.coalesce(F.col("h_htf_ok"), F.lit(False))).drop("h_htf_ok", "h_open_time")


def directional_accuracy(events: DataFrame) -> DataFrame:
    """Breakouts by range type and direction, and one row ('all', 'all') over the directional
    types; Resistance breaking down and Support breaking up count as correct."""
    br = events.where(F.col("event").startswith("breakout"))
    correct = ((F.col("range_type") == "Resistance") & (F.col("event") == "breakout_down")) | \
              ((F.col("range_type") == "Support") & (F.col("event") == "breakout_up"))
    n = [F.count(F.lit(1)).alias("n"), F.count_if(correct).alias("n_correct")]
    each = br.groupBy("range_type", "event").agg(*n)
    every = br.where(F.col("range_type").isin("Resistance", "Support")).agg(*n)
    return each.unionByName(every.select(F.lit("all").alias("range_type"), F.lit("all").alias("event"), "*"))


def imbalance_band(imb_pct: Column) -> Column:
    """L21 bands of |imbalance| %: <10, 10-15, 15-20, >20."""
    a = F.abs(imb_pct)
    return F.when(a < 10, "<10").when(a < 15, "10-15").when(a <= 20, "15-20").otherwise(">20")


def simple_imbalance(bars: DataFrame, min_bars: int = 5, lookback: int = 21, min_imb_pct: float = 15.0) -> DataFrame:
    """L9 (short strategy variant): consolidation = SMA20(|body|) < 0.5 ATR;
    per consolidating bar with >= ``min_bars`` bars in the run, volume of the
    last min(run, 21) bars with high >= 0.99 * run high and with
    low <= 1.01 * run low; imbalance % = (hi - lo) / max(hi, lo) * 100, 0
    unless both are > 0; Resistance / Support at >= ``min_imb_pct``."""
    d = narrow_bars(bars, "body_sma")
    d = series.halo_windows(d, lambda w: {"_st": F.col("is_narrow") & ~F.coalesce(
        F.lag("is_narrow").over(w), F.lit(False))}, back=1)
    d = d.withColumn("_s", F.when(F.col("_st"), F.col("bar_idx")))
    blk = F.floor(F.col("bar_idx") / F.lit(series.block_rows(d))).cast("long")
    d = J.scan_carry(d, ["_s"], K, ["bar_idx"], blk, forward=True)
    d = d.withColumn("run_start", F.when(F.col("is_narrow"), F.col("_s_carried")))
    d = d.withColumn("cons_bars", F.col("bar_idx") - F.col("run_start") + 1)
    seg = d.where(F.col("run_start").isNotNull())
    seg = series.segment_running(seg, "high", "run_start", "cons_high", "max")
    seg = series.segment_running(seg, "low", "run_start", "cons_low", "min")
    d = J.null_safe_join(d, seg.select(*K, "bar_idx", "cons_high", "cons_low"), [*K, "bar_idx"], "left")

    def build(w):
        return {"_win": F.collect_list(F.struct(F.col("bar_idx").alias("i"), F.col("high").alias("h"),
                                                F.col("low").alias("l"), F.col("volume").alias("v")))
                .over(w.rowsBetween(-(lookback - 1), 0))}

    d = series.halo_windows(d, build, back=lookback)
    inrun = F.filter("_win", lambda x: x["i"] >= F.col("run_start"))
    vh = F.aggregate(F.filter(inrun, lambda x: x["h"] >= 0.99 * F.col("cons_high")), F.lit(0.0),
                     lambda acc, x: acc + x["v"])
    vl = F.aggregate(F.filter(inrun, lambda x: x["l"] <= 1.01 * F.col("cons_low")), F.lit(0.0),
                     lambda acc, x: acc + x["v"])
    imb = F.when((vh > 0) & (vl > 0), (vh - vl) / F.greatest(vh, vl) * 100).otherwise(F.lit(0.0))
    ok = F.col("is_narrow") & (F.col("cons_bars") >= min_bars)
    d = d.withColumns({"vol_at_high": F.when(ok, vh), "vol_at_low": F.when(ok, vl), "simple_imbalance": F.when(ok, imb)})
    d = d.withColumn("simple_type", F.when(F.abs("simple_imbalance") >= min_imb_pct,
                                           F.when(F.col("simple_imbalance") > 0, "Resistance").otherwise("Support")))
    return d.drop("_win", "_st", "_s", "_s_carried")
