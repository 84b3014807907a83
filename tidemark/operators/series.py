"""Skew-safe per-series execution.

Almost every operator works "per (exchange, symbol, interval), ordered by
open_time".  A plain ``Window.partitionBy(*KEY)`` puts a whole key in one
task, which fails when one key holds a large share of all rows.  This module
gives the three building blocks the rest of the library uses instead:

* ``index_series`` — a global 0-based position per key (``bar_idx``),
  computed from per-(key, time chunk) counts: one small aggregate, a join to
  a table with one row per chunk, and a ``row_number`` inside each chunk.
* ``halo_windows`` — window expressions over fixed-size blocks of
  ``bar_idx`` with ``back``/``fwd`` halo rows copied from the neighbouring
  blocks, so any bounded row frame gives the same answer as a whole-key
  window while no task ever sees more than one block plus halos.
* ``ewm`` — exact exponential smoothing (``adjust=False``) as a blocked
  linear scan: each block is smoothed on its own with a zero carry, block
  summaries are folded per key (one row per block), and the carry is added
  back with a closed-form correction.

Block and chunk sizes come from the session conf
(``tidemark.series.blockRows``, ``tidemark.series.chunkBars``) so tests can
make them tiny and exercise every boundary.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timeutil import interval_ms
from tidemark.schemas import INTERVAL_MS, KEY

BLOCK_ROWS_CONF = "tidemark.series.blockRows"
CHUNK_BARS_CONF = "tidemark.series.chunkBars"
DEFAULT_BLOCK_ROWS = 1_000_000
DEFAULT_CHUNK_BARS = 1_000_000
TIE_BREAK = ("close_time", "open", "high", "low", "close", "volume")


def _conf(df: DataFrame, name: str, default: int) -> int:
    v = df.sparkSession.conf.get(name, None)
    return int(v) if v else default


def block_rows(df: DataFrame) -> int:
    return _conf(df, BLOCK_ROWS_CONF, DEFAULT_BLOCK_ROWS)


def pinned(df: DataFrame) -> DataFrame:
    """``df`` as a reliable checkpoint (once): a scan helper uses its input two or three
    times, and without this a chain of helpers would read the source exponentially often."""
    if getattr(df, "_tidemark_pinned", False):
        return df
    from tidemark.session import cut_lineage
    out = cut_lineage(df)
    out._tidemark_pinned = True
    return out


def _join(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    from tidemark.operators.joins import null_safe_join
    return null_safe_join(a, b, keys, how)


def index_series(df: DataFrame, key: Sequence[str] = KEY, order: Sequence[str] = ("open_time",),
                 idx: str = "bar_idx", span_ms: int | None = None) -> DataFrame:
    """Add ``idx`` = 0-based position of the row in its key, by ``order``.

    The first ``order`` column must be epoch ms.  Rows are cut into time
    chunks of ``span_ms`` (default: interval length x chunkBars, so a chunk
    holds a bounded number of bars; labels without a known length, and NULL,
    count as the shortest).  NULL keys are keys of their own.  Bars of one time are
    ordered by their other columns (``TIE_BREAK``), so the order is total.  Positions inside a chunk come from a
    ``row_number`` over (key, chunk) and the chunk's offset from a running sum
    over the small per-chunk count table.
    """
    key = list(key)
    t0 = order[0]
    if tuple(order) == ("open_time",):
        order = [*order, *[c for c in TIE_BREAK if c in df.columns]]
    chunk = F.lit(_conf(df, CHUNK_BARS_CONF, DEFAULT_CHUNK_BARS))
    if span_ms is not None:
        span = F.lit(int(span_ms))
    elif "interval" in df.columns:  # an unknown or NULL label counts as the shortest interval
        span = F.coalesce(interval_ms(F.col("interval")), F.lit(min(INTERVAL_MS.values()))) * chunk
    else:
        span = F.lit(min(INTERVAL_MS.values())) * chunk
    d = df.withColumn("_chunk", F.floor(F.col(t0) / span).cast("long"))
    counts = d.groupBy(*key, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    wc = Window.partitionBy(*key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*key, "_chunk", F.coalesce(F.sum("_n").over(wc), F.lit(0)).cast("long").alias("_off"))
    w = Window.partitionBy(*key, "_chunk").orderBy(*order)
    return (_join(d, offsets, [*key, "_chunk"])
            .withColumn(idx, F.col("_off") + F.row_number().over(w) - 1)
            .drop("_chunk", "_off"))


def _halo_explode(df: DataFrame, idx: str, back: int, fwd: int, b: int) -> DataFrame:
    blk = F.floor(F.col(idx) / F.lit(b)).cast("long")
    pos = F.col(idx) - blk * F.lit(b)
    targets = [F.struct(blk.alias("b"), F.lit(True).alias("core"))]
    if back > 0:
        targets.append(F.when(pos >= F.lit(b - back), F.struct((blk + 1).alias("b"), F.lit(False).alias("core"))))
    if fwd > 0:
        targets.append(F.when((pos < F.lit(fwd)) & (blk > 0),
                              F.struct((blk - 1).alias("b"), F.lit(False).alias("core"))))
    arr = F.filter(F.array(*targets), lambda x: x.isNotNull())
    return (df.withColumn("_t", F.explode(arr))
            .withColumn("_blk", F.col("_t.b")).withColumn("_core", F.col("_t.core")).drop("_t"))


def halo_windows(df: DataFrame, build: Callable[[Window], dict[str, Column]], back: int = 0, fwd: int = 0,
                 key: Sequence[str] = KEY, idx: str = "bar_idx", stages: int = 1) -> DataFrame:
    """Evaluate bounded-frame window columns per key without whole-key partitions.

    ``build(w)`` returns ``{name: expr}``; ``w`` is partitioned by key and block
    and ordered by ``idx``.  ``back``/``fwd`` must cover the widest frame
    reach (e.g. ``rowsBetween(-19, 0)`` needs ``back >= 19``; ``lead(c, 24)``
    needs ``fwd >= 24``).  ``build`` may return a list of dicts for dependent
    stages (each stage sees the previous stage's columns); reaches add up.
    """
    b = block_rows(df)
    if back > b or fwd > b:
        raise ValueError(f"halo ({back}, {fwd}) exceeds block size {b}")
    d = _halo_explode(df, idx, back, fwd, b)
    w = Window.partitionBy(*key, "_blk").orderBy(idx)
    built = build(w)
    for stage in (built if isinstance(built, list) else [built]):
        d = d.withColumns(stage)
    return d.where("_core").drop("_blk", "_core")


def block_apply(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str,
                back: int = 0, fwd: int = 0, key: Sequence[str] = KEY, idx: str = "bar_idx") -> DataFrame:
    """Grouped-map over blocks of one key with halo rows (``_core`` marks own rows).

    ``fn`` gets a pandas frame sorted by ``idx`` and must return only rows for
    core positions (or derived events anchored at core positions).
    """
    b = block_rows(df)
    d = _halo_explode(df, idx, back, fwd, b)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return fn(pdf.sort_values(idx, kind="stable").reset_index(drop=True))

    return d.groupBy(*key, "_blk").applyInPandas(run, schema)


def density_blocks(df: DataFrame, key: Sequence[str], t: str, grain: int, out: str = "_cb") -> DataFrame:
    """Add ``out``: a block number per key that grows with ``t``, cut so that a block holds about ``block_rows`` rows at any
    density.  Rows are counted per key and ``grain`` of ``t``; a running sum over these counts gives the blocks (a single grain is never cut)."""
    key = list(key)
    g = F.floor(F.col(t) / F.lit(grain)).cast("long")
    counts = df.groupBy(*key, g.alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*key).orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*key, "_g", F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / F.lit(block_rows(df))).cast("long").alias(out))
    return _join(df.withColumn("_g", g), counts, [*key, "_g"]).drop("_g")


# ---------------------------------------------------------------- EWM scan

def _local_ewm(x: np.ndarray, alpha: float):
    """Per block: zero-carry smoothing, first-value-seeded smoothing, carry decay."""
    s = pd.Series(x, dtype="float64")
    valid = s.notna().to_numpy()
    zero = pd.concat([pd.Series([0.0]), s], ignore_index=True)
    l0 = zero.ewm(alpha=alpha, adjust=False, ignore_na=True).mean().to_numpy()[1:]
    seeded = s.ewm(alpha=alpha, adjust=False, ignore_na=True).mean().to_numpy()
    decay = np.power(1.0 - alpha, np.cumsum(valid))
    seen = np.cumsum(valid) > 0
    return l0, seeded, decay, seen


def ewm(df: DataFrame, specs: Sequence[tuple[str, float, str]], key: Sequence[str] = KEY,
        idx: str = "bar_idx") -> DataFrame:
    """Exponential smoothing ``e_t = e_{t-1} + alpha (x_t - e_{t-1})`` seeded
    with the first non-NULL value (pandas ``ewm(alpha, adjust=False,
    ignore_na=True)``); NULL inputs hold the previous value.

    ``specs`` = ``[(input_col, alpha, output_col), ...]`` evaluated in one
    pass.  Exact (up to floating point) for any block size.
    """
    key = list(key)
    b = block_rows(df)
    ins = [s[0] for s in specs]
    df = pinned(df)
    d = df.withColumn("_blk", F.floor(F.col(idx) / F.lit(b)).cast("long"))
    part = d.select(*key, "_blk", idx, *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(ins)])
    ktypes = {f.name: f.dataType for f in df.schema.fields}
    fields = [T.StructField(k, ktypes[k]) for k in key] + [T.StructField("_blk", T.LongType()),
                                                          T.StructField(idx, T.LongType())]
    for i in range(len(specs)):
        fields += [T.StructField(f"_l0{i}", T.DoubleType()), T.StructField(f"_ls{i}", T.DoubleType()),
                   T.StructField(f"_p{i}", T.DoubleType()), T.StructField(f"_seen{i}", T.BooleanType())]
    local_schema = T.StructType(fields)

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(idx, kind="stable").reset_index(drop=True)
        out = pdf[[*key, "_blk", idx]].copy()
        for i, (_, alpha, _) in enumerate(specs):
            l0, ls, p, seen = _local_ewm(pdf[f"_x{i}"].to_numpy(dtype="float64", na_value=np.nan), alpha)
            out[f"_l0{i}"], out[f"_ls{i}"], out[f"_p{i}"], out[f"_seen{i}"] = l0, ls, p, seen
        return out

    loc = pinned(part.groupBy(*key, "_blk").applyInPandas(local, local_schema))

    # One row per block: values at the block's last row.
    last = F.max_by(F.struct(*[F.col(f"_{n}{i}") for i in range(len(specs)) for n in ("l0", "ls", "p", "seen")]),
                    F.col(idx))
    summ = loc.groupBy(*key, "_blk").agg(last.alias("_s")).select(*key, "_blk", "_s.*")

    carry_fields = [T.StructField(k, ktypes[k]) for k in key] + [T.StructField("_blk", T.LongType())]
    carry_fields += [T.StructField(f"_c{i}", T.DoubleType()) for i in range(len(specs))]

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_blk").reset_index(drop=True)
        out = pdf[[*key, "_blk"]].copy()
        for i in range(len(specs)):
            e = np.nan
            carries = np.empty(len(pdf))
            l0, ls, p, seen = (pdf[f"_l0{i}"].to_numpy(), pdf[f"_ls{i}"].to_numpy(),
                               pdf[f"_p{i}"].to_numpy(), pdf[f"_seen{i}"].to_numpy())
            for j in range(len(pdf)):
                carries[j] = e
                if seen[j]:
                    e = ls[j] if np.isnan(e) else l0[j] + p[j] * e
            out[f"_c{i}"] = carries
        return out

    carry = summ.groupBy(*key).applyInPandas(fold, T.StructType(carry_fields))
    res = _join(loc, carry, [*key, "_blk"], "left")
    outs = {}
    for i, (_, _, name) in enumerate(specs):
        c = F.col(f"_c{i}")
        has_carry = c.isNotNull() & ~F.isnan(c)
        val = F.when(has_carry, F.col(f"_l0{i}") + F.col(f"_p{i}") * c).when(F.col(f"_seen{i}"), F.col(f"_ls{i}"))
        outs[name] = F.when(~F.isnan(val), val)
    res = res.select(*key, idx, *[v.alias(k) for k, v in outs.items()])
    return _join(df, res, [*key, idx], "left")


# ------------------------------------------------------- carry-forward scan

def carry_last(df: DataFrame, cols: Sequence[str], key: Sequence[str], order: Sequence[str],
               idx: str = "bar_idx", forward: bool = True) -> DataFrame:
    """For each row, the value of ``cols`` on the latest row (by ``idx``) at or
    before it where the value is not NULL ("last non-null", a segmented scan).
    ``forward=False`` gives the earliest row at or after it instead.

    Within a block: ``last/first(ignorenulls)`` over a running frame; across
    blocks: the per-block last value is carried from a running window over the
    block-summary table (one row per block).
    """
    key = list(key)
    b = block_rows(df)
    d = pinned(df).withColumn("_blk", F.floor(F.col(idx) / F.lit(b)).cast("long"))
    # Spark evaluates a frame that ends with the partition anew for every row: backward is a running frame in falling order
    way = Column.asc if forward else Column.desc
    frame = Window.partitionBy(*key, "_blk").orderBy(way(F.col(idx))).rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy(*key).orderBy(way(F.col("_blk"))).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumns({f"_in_{c}": F.last(c, ignorenulls=True).over(frame) for c in cols})
    edge = F.max_by if forward else F.min_by
    summ = d.groupBy(*key, "_blk").agg(*[edge(F.col(f"_in_{c}"), F.col(idx)).alias(f"_b_{c}") for c in cols])
    summ = summ.select(*key, "_blk", *[F.last(f"_b_{c}", ignorenulls=True).over(outer).alias(f"_o_{c}") for c in cols])
    d = _join(d, summ, [*key, "_blk"], "left")
    return d.withColumns({c + "_carried": F.coalesce(F.col(f"_in_{c}"), F.col(f"_o_{c}")) for c in cols}) \
            .drop("_blk", *[f"_in_{c}" for c in cols], *[f"_o_{c}" for c in cols])


_PD_DTYPES = {T.LongType: "Int64", T.IntegerType: "Int32", T.DoubleType: "float64", T.BooleanType: "boolean"}


def pandas_frame(cols: dict, schema: T.StructType) -> pd.DataFrame:
    """A pandas frame for a grouped-map result with dtypes taken from
    ``schema`` (an empty result with untyped columns fails Arrow conversion)."""
    out = {}
    for f in schema.fields:
        v = cols.get(f.name, [])
        dt = _PD_DTYPES.get(type(f.dataType), object)
        out[f.name] = pd.Series(v, dtype=dt) if len(v) == 0 or dt is object else \
            pd.Series([None if x is None or (isinstance(x, float) and x != x and dt != "float64") else x for x in v],
                      dtype=object).astype(dt)
    return pd.DataFrame(out)


def segment_running(df: DataFrame, value: str, seg: str, out: str, fn: str = "max",
                    key: Sequence[str] = KEY, idx: str = "bar_idx") -> DataFrame:
    """W8 at any segment length: running max/min of ``value`` from the start
    of segment ``seg`` (a segment id per key, e.g. its first ``bar_idx``).
    Block-local running extreme + the extreme carried from earlier blocks of
    the same segment (window over a one-row-per-(segment, block) summary)."""
    key = list(key)
    b = block_rows(df)
    agg = F.max if fn == "max" else F.min
    d = pinned(df).withColumn("_sb", F.floor(F.col(idx) / F.lit(b)).cast("long"))
    w = Window.partitionBy(*key, seg, "_sb").orderBy(idx).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_loc", agg(value).over(w))
    summ = d.groupBy(*key, seg, "_sb").agg(agg(value).alias("_bx"))
    wo = Window.partitionBy(*key, seg).orderBy("_sb").rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.select(*key, seg, "_sb", agg("_bx").over(wo).alias("_carry"))
    d = _join(d, summ, [*key, seg, "_sb"], "left")
    both = F.greatest("_loc", "_carry") if fn == "max" else F.least("_loc", "_carry")
    return d.withColumn(out, both).drop("_sb", "_loc", "_carry")


def segment_runs(df: DataFrame, specs: Sequence[tuple[str, str, str]], seg: str, key: Sequence[str] = KEY, idx: str = "bar_idx") -> DataFrame:
    """Several running aggregates of a segment in one pass: ``specs`` are (column, output, max / min / sum), from the start of
    segment ``seg`` up to the row.  The state of a block (its extremes and sums) composes with that of the blocks before it."""
    key = list(key)
    fn = {"max": F.max, "min": F.min, "sum": F.sum}
    both = {"max": F.greatest, "min": F.least, "sum": lambda a, b: F.coalesce(a + b, a, b)}
    d = pinned(df).withColumn("_sb", F.floor(F.col(idx) / F.lit(block_rows(df))).cast("long"))
    w = Window.partitionBy(*key, seg, "_sb").orderBy(idx).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumns({f"_l{i}": fn[f](v).over(w) for i, (v, _, f) in enumerate(specs)})
    state = d.groupBy(*key, seg, "_sb").agg(*[fn[f](v).alias(f"_b{i}") for i, (v, _, f) in enumerate(specs)])
    before = Window.partitionBy(*key, seg).orderBy("_sb").rowsBetween(Window.unboundedPreceding, -1)
    state = state.select(*key, seg, "_sb", *[fn[f](f"_b{i}").over(before).alias(f"_c{i}") for i, (_, _, f) in enumerate(specs)])
    d = _join(d, state, [*key, seg, "_sb"], "left")
    d = d.withColumns({out: both[f](F.col(f"_l{i}"), F.col(f"_c{i}")) for i, (_, out, f) in enumerate(specs)})
    return d.drop("_sb", *[f"_{x}{i}" for i in range(len(specs)) for x in "lc"])


def running_sum(df: DataFrame, value: str, out: str, key: Sequence[str] = KEY, idx: str = "bar_idx") -> DataFrame:
    """Prefix sum of ``value`` per key in ``idx`` order: block-local running
    sum plus the total of earlier blocks (one-row-per-block summary)."""
    key = list(key)
    b = block_rows(df)
    d = pinned(df).withColumn("_rb", F.floor(F.col(idx) / F.lit(b)).cast("long"))
    w = Window.partitionBy(*key, "_rb").orderBy(idx).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_loc", F.sum(value).over(w))
    summ = d.groupBy(*key, "_rb").agg(F.sum(value).alias("_bs"))
    wo = Window.partitionBy(*key).orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.select(*key, "_rb", F.coalesce(F.sum("_bs").over(wo), F.lit(0.0)).alias("_carry"))
    d = _join(d, summ, [*key, "_rb"], "left")
    return d.withColumn(out, F.col("_loc") + F.col("_carry")).drop("_rb", "_loc", "_carry")
