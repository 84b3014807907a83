"""Joins (J1-J9) expressed with equi-joins, unions and scans only.

No operator here lets Spark fall back to a nested-loop or a per-key
all-pairs join: as-of joins are a union + carry scan, range joins are
bucketed equi-joins with a residual ``between``, horizon lookups are
``lead`` over the halo-blocked series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import series

def null_safe_join(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL equals NULL (a series key or a group may be NULL)."""
    right = b.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return a.join(right, same, how).drop(*[f"_k_{k}" for k in keys])


def join_universe(df: DataFrame, universe: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep rows whose key is in ``universe`` (semi join; the runtime
    re-plan broadcasts the keys when their measured size allows it)."""
    return df.join(universe.select(*keys).distinct(), list(keys), "left_semi")


def first_bar_where(entries: DataFrame, bars: DataFrame, key: Sequence[str], idx_col: str, cond: Column,
                    first_window: int = 64, payload: Sequence[str] = (), also: Sequence[str] = ()) -> DataFrame:
    """For each entry (``key``, ``idx_col`` and the columns ``also``, which tell entries of one bar apart) the first bar (``_bi`` in ``bars``) after it on which ``cond``
    holds: ``_hit`` and the ``payload`` columns of that bar; entries without one are absent.  No horizon:
    windows grow four-fold per round and only open entries go on.  The bars are
    materialized once."""
    from tidemark.session import cut_lineage
    key, who = list(key), [*key, idx_col, *also]
    bars = cut_lineage(bars)
    last = bars.groupBy(*key).agg(F.max("_bi").alias("_last"))
    left = cut_lineage(null_safe_join(entries, last, key))
    found, lo, width = None, 1, first_window
    while True:
        hi = lo + width - 1
        pairs = within_rows(left, bars, key, idx_col, lo, hi, right_idx="_bi").where(cond)
        hit = cut_lineage(pairs.groupBy(*who).agg(F.min("_bi").alias("_hit"),
                                                           *[F.min_by(c, "_bi").alias(c) for c in payload]))
        found = hit if found is None else found.unionByName(hit)
        done = hit.select(*[F.col(c).alias(f"_d_{c}") for c in who])
        same = [F.col(c).eqNullSafe(F.col(f"_d_{c}")) for c in who]
        left = cut_lineage(left.join(done, same, "left_anti").where(F.col(idx_col) + hi < F.col("_last")))
        if left.limit(1).count() == 0:
            return found
        lo, width = hi + 1, width * 4


def scan_carry(df: DataFrame, cols: Sequence[str], key: Sequence[str], order: Sequence[Column | str],
               block: Column, forward: bool = True) -> DataFrame:
    """Segmented "last non-NULL so far" (``forward``) or "first non-NULL from
    here on" scan of ``cols`` per key, ordered by ``order``.

    Rows are cut into blocks by ``block`` (monotone in ``order``, e.g. a time
    bucket).  Inside a block a running ``last/first(ignorenulls)`` does the
    work; a block-summary table (one row per block) supplies the value
    carried in from earlier/later blocks.  Adds ``<col>_carried``.
    """
    key = list(key)
    d = series.pinned(df).withColumn("_cb", block)
    # Spark evaluates a frame that ends with the partition anew for every row: backward is a running frame in falling order
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    way = Column.asc if forward else Column.desc
    frame = Window.partitionBy(*key, "_cb").orderBy(*map(way, order)).rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy(*key).orderBy(way(F.col("_cb"))).rowsBetween(Window.unboundedPreceding, -1)
    edge = F.max_by if forward else F.min_by
    d = d.withColumns({f"_in_{c}": F.last(c, ignorenulls=True).over(frame) for c in cols})
    ord_struct = F.struct(*order)
    summ = d.groupBy(*key, "_cb").agg(*[edge(F.col(f"_in_{c}"), ord_struct).alias(f"_b_{c}") for c in cols])
    summ = summ.select(*key, "_cb", *[F.last(f"_b_{c}", ignorenulls=True).over(outer).alias(f"_o_{c}") for c in cols])
    d = null_safe_join(d, summ, [*key, "_cb"], "left")
    return (d.withColumns({f"{c}_carried": F.coalesce(F.col(f"_in_{c}"), F.col(f"_o_{c}")) for c in cols})
            .drop("_cb", *[f"_in_{c}" for c in cols], *[f"_o_{c}" for c in cols]))


def _asof(left: DataFrame, right: DataFrame, on: str, by: Sequence[str], right_cols: Sequence[str],
          forward: bool, tolerance: int | None, grain: int, prefix: str, right_on: str | None) -> DataFrame:
    by = list(by)
    lcols = [c for c in left.columns]
    ron = right_on or on
    payload = F.struct(F.col(ron).alias("_t"), *[F.col(c) for c in right_cols])
    # Backward: right rows sort before left rows at equal time (t_r <= t_l).
    # Forward:  left rows sort before right rows at equal time (t_r >= t_l).
    r_side, l_side = (1, 0) if forward else (0, 1)
    ptype = right.select(payload).schema[0].dataType
    L = left.select(*[F.col(c) for c in lcols], F.col(on).alias("_ut"), F.lit(l_side).alias("_side"),
                    F.lit(None).cast(ptype).alias("_p"))
    R = right.select(*[F.col(c).alias(c) for c in by], F.col(ron).alias("_ut"), F.lit(r_side).alias("_side"),
                     payload.alias("_p"))
    for c in lcols:
        if c not in by:
            R = R.withColumn(c, F.lit(None).cast(left.schema[c].dataType))
    u = L.unionByName(R.select(*L.columns))
    u = series.density_blocks(series.pinned(u), by, "_ut", grain, "_db")
    # right rows of one time are ordered by their payload, so the match is determined
    u = scan_carry(u, ["_p"], by, ["_ut", "_side", "_p"], F.col("_db"), forward=not forward)
    out = u.where(F.col("_side") == l_side)
    m = F.col("_p_carried")
    if tolerance is not None:
        gap = (m["_t"] - F.col("_ut")) if forward else (F.col("_ut") - m["_t"])
        m = F.when(gap <= F.lit(tolerance), m)
    out = out.withColumn("_m", m)
    return out.select(*lcols, F.col("_m._t").alias(f"{prefix}{ron}"),
                      *[F.col(f"_m.{c}").alias(f"{prefix}{c}") for c in right_cols])


def asof_backward(left: DataFrame, right: DataFrame, on: str, by: Sequence[str], right_cols: Sequence[str],
                  tolerance: int | None = None, grain: int = 3_600_000, prefix: str = "r_",
                  right_on: str | None = None) -> DataFrame:
    """For each left row, the latest right row with ``right.on <= left.on``
    in the same ``by`` group, optionally within ``tolerance``.  Left rows
    without a match are kept with NULLs (true left as-of join).  The scan runs over blocks of about
    ``series.block_rows`` rows, counted per ``grain`` of time, whatever the density."""
    return _asof(left, right, on, by, right_cols, False, tolerance, grain, prefix, right_on)


def asof_forward(left: DataFrame, right: DataFrame, on: str, by: Sequence[str], right_cols: Sequence[str],
                 tolerance: int | None = None, grain: int = 3_600_000, prefix: str = "r_",
                 right_on: str | None = None) -> DataFrame:
    """For each left row, the earliest right row with ``right.on >= left.on``."""
    return _asof(left, right, on, by, right_cols, True, tolerance, grain, prefix, right_on)


HEAVY_ROWS_CONF = "tidemark.joins.heavyRows"


def _bucket_join(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join on ``by`` and the bucket ``_bk``.  The right rows of a bucket that holds more than ``heavyRows`` (200,000) of them are dealt over
    salts and its left rows are repeated for each, so that no task holds a hot bucket whole."""
    heavy, on = int(left.sparkSession.conf.get(HEAVY_ROWS_CONF, None) or 200_000), [*by, "_bk"]
    hot = right.groupBy(*on).agg(F.ceil(F.count(F.lit(1)) / F.lit(heavy)).cast("int").alias("_salts")).where("_salts > 1")
    hot = series.pinned(hot)
    if hot.isEmpty():
        return null_safe_join(left, right, on)
    salts = F.coalesce("_salts", F.lit(1))
    a = null_safe_join(left, hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    row = F.xxhash64(*[F.col(f"`{c}`") for c in right.columns])
    b = null_safe_join(right, hot, on, "left").withColumn("_salt", F.pmod(row, salts).cast("int")).drop("_salts")
    return null_safe_join(a, b, [*on, "_salt"]).drop("_salt")


def within_time_window(left: DataFrame, right: DataFrame, by: Sequence[str], lo_col: str, hi_col: str,
                       t_col: str, width_ms: int) -> DataFrame:
    """J5 (time form): pairs where ``lo <= right.t <= hi`` and ``hi - lo <= width_ms``.

    Right rows get ``bucket = t div width``; each left row is exploded to the
    buckets its interval touches (at most two), then an equi-join on
    (by, bucket) with the residual range test.  Work is proportional to the
    matching pairs, never to all pairs of a key.
    """
    by = list(by)
    b0 = F.floor(F.col(lo_col) / F.lit(width_ms)).cast("long")
    b1 = F.floor(F.col(hi_col) / F.lit(width_ms)).cast("long")
    lx = left.withColumn("_bk", F.explode(F.sequence(b0, b1)))
    rx = right.withColumn("_bk", F.floor(F.col(t_col) / F.lit(width_ms)).cast("long"))
    return (_bucket_join(lx, rx, by)
            .where((F.col(t_col) >= F.col(lo_col)) & (F.col(t_col) <= F.col(hi_col))).drop("_bk"))


def within_rows(left: DataFrame, right: DataFrame, by: Sequence[str], idx_col: str, lo: int, hi: int,
                right_idx: str = "bar_idx") -> DataFrame:
    """J5 (index form): pairs with ``left.idx + lo <= right.idx <= left.idx + hi``
    as a bucketed equi-join (bucket width = hi - lo + 1)."""
    width = hi - lo + 1
    b0 = F.floor((F.col(idx_col) + F.lit(lo)) / F.lit(width)).cast("long")
    lx = left.withColumn("_bk", F.explode(F.array(b0, b0 + 1)))
    rx = right.withColumn("_bk", F.floor(F.col(right_idx) / F.lit(width)).cast("long"))
    return (_bucket_join(lx, rx, list(by))
            .where(F.col(right_idx).between(F.col(idx_col) + lo, F.col(idx_col) + hi)).drop("_bk"))


def at_horizons(bars: DataFrame, col: str, horizons: Sequence[int], prefix: str) -> DataFrame:
    """``col`` h bars ahead for each h (one halo-blocked window)."""
    return series.halo_windows(bars, lambda w: {f"{prefix}{h}": F.lead(col, h).over(w) for h in horizons},
                               fwd=max(horizons))


def nth_previous(df: DataFrame, flag: str, value_cols: Sequence[str], n: int, key: Sequence[str],
                 idx: str = "bar_idx", strictly_before: bool = True, prefix: str = "prev",
                 block_rows: int = 1 << 20) -> DataFrame:
    """The values on the n-th most recent flagged row before each row
    (``strictly_before=False``: at or before).

    Flagged rows are numbered per key (``_fno``); every row carries the
    number of flagged rows seen so far (segmented scan) and the wanted row is
    fetched with an equi-join on (key, number).  Adds
    ``<prefix><n>_<col>`` and ``<prefix><n>_idx``.
    """
    key = list(key)
    flagged = df.where(F.col(flag)).select(*key, F.col(idx).alias("_fidx"), *value_cols)
    numbered = series.index_series(flagged, key=key, order=("_fidx",), idx="_fno", span_ms=block_rows)
    marks = null_safe_join(df, numbered.select(*key, F.col("_fidx").alias(idx), "_fno"), [*key, idx], "left")
    marks = marks.withColumn("_self", F.col("_fno").isNotNull())
    blk = F.floor(F.col(idx) / F.lit(block_rows)).cast("long")
    marks = scan_carry(marks, ["_fno"], key, [idx], blk, forward=True)
    seen = F.coalesce(F.col("_fno_carried") + 1, F.lit(0))  # flagged rows at or before this row
    if strictly_before:
        seen = seen - F.col("_self").cast("long")
    marks = marks.withColumn("_want", seen - F.lit(n))
    tgt = numbered.select(*key, F.col("_fno").alias("_want"), F.col("_fidx").alias(f"{prefix}{n}_idx"),
                          *[F.col(c).alias(f"{prefix}{n}_{c}") for c in value_cols])
    return null_safe_join(marks, tgt, [*key, "_want"], "left").drop("_fno", "_fno_carried", "_self", "_want")


def hash_shuffle_column(df: DataFrame, col: str, seed: int, id_col: str, rows_per_salt: int = 100_000) -> DataFrame:
    """Permute ``col`` across rows reproducibly and in parallel.

    Rows are salted by the md5 of (seed, id), with as many salts as keep about
    ``rows_per_salt`` rows in each (64 at least); inside a salt row k (by id)
    receives the value of row k by a second md5 order.  No global
    single-partition window; ``id_col`` must be unique.
    """
    salts = max(64, -(-df.count() // rows_per_salt))
    rid = F.col(id_col).cast("string")
    digest = lambda s: F.md5(F.concat_ws(":", F.lit(str(s)), rid))
    d = df.withColumn("_salt", F.pmod(F.conv(F.substring(digest(seed), 1, 8), 16, 10).cast("long"), F.lit(salts)))
    w1 = Window.partitionBy("_salt").orderBy(id_col)
    w2 = Window.partitionBy("_salt").orderBy(digest(seed + 1), id_col)
    a = d.withColumn("_k", F.row_number().over(w1))
    b = d.select("_salt", F.col(col).alias("_perm"), F.row_number().over(w2).alias("_k"))
    return a.join(b, ["_salt", "_k"]).withColumn(col, F.col("_perm")).drop("_salt", "_k", "_perm")
