"""Window building blocks (W1-W11) as column expressions over a window spec.

All functions take a window ``w`` that is ordered by the bar index; callers
evaluate them through ``series.halo_windows`` so frames never need a whole
key in one task.  Frames are rows-based, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import series
from tidemark.schemas import KEY


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trailing(w: Window, n: int) -> Window:
    """Last ``n`` rows including the current one."""
    return w.rowsBetween(-(n - 1), 0)


def prior(w: Window, n: int) -> Window:
    """The ``n`` rows before the current one."""
    return w.rowsBetween(-n, -1)


def forward(w: Window, lo: int, hi: int) -> Window:
    return w.rowsBetween(lo, hi)


def strict(agg: Column, x, frame: Window, n: int) -> Column:
    """Pandas ``min_periods=n`` — NULL until ``n`` non-NULL values are in the frame."""
    return F.when(F.count(c(x)).over(frame) >= n, agg.over(frame))


def sma(x, w: Window, n: int, full: bool = True) -> Column:
    f = trailing(w, n)
    return strict(F.avg(c(x)), x, f, n) if full else F.avg(c(x)).over(f)


def rolling_std(x, w: Window, n: int, full: bool = True) -> Column:
    f = trailing(w, n)
    return strict(F.stddev_samp(c(x)), x, f, n) if full else F.stddev_samp(c(x)).over(f)


def rolling_max(x, w: Window, n: int, full: bool = True) -> Column:
    f = trailing(w, n)
    return strict(F.max(c(x)), x, f, n) if full else F.max(c(x)).over(f)


def rolling_min(x, w: Window, n: int, full: bool = True) -> Column:
    f = trailing(w, n)
    return strict(F.min(c(x)), x, f, n) if full else F.min(c(x)).over(f)


def rolling_pct_rank(x, w: Window, n: int) -> Column:
    """Percent rank of the current value among the last ``n`` (ties
    averaged, pandas ``rank(pct=True)``): (#less + (#equal + 1) / 2) / n.
    NULL until the window holds ``n`` non-NULL values or when the current
    value is NULL."""
    f = trailing(w, n)
    vals = F.collect_list(c(x)).over(f)
    cur = c(x)
    less = F.size(F.filter(vals, lambda v: v < cur))
    eq = F.size(F.filter(vals, lambda v: v == cur))
    return F.when(cur.isNotNull() & (F.size(vals) >= n), (less + (eq + 1) / 2.0) / F.size(vals))


def strict_local_max(x, w: Window, left: int, right: int) -> Column:
    """Strictly greater than each of ``left`` previous and ``right`` next
    values, both sides complete."""
    lf, rf = w.rowsBetween(-left, -1), w.rowsBetween(1, right)
    return ((F.count(c(x)).over(lf) == left) & (F.count(c(x)).over(rf) == right)
            & (c(x) > F.max(c(x)).over(lf)) & (c(x) > F.max(c(x)).over(rf)))


def strict_local_min(x, w: Window, left: int, right: int) -> Column:
    lf, rf = w.rowsBetween(-left, -1), w.rowsBetween(1, right)
    return ((F.count(c(x)).over(lf) == left) & (F.count(c(x)).over(rf) == right)
            & (c(x) < F.min(c(x)).over(lf)) & (c(x) < F.min(c(x)).over(rf)))


def run_id(flag, w: Window) -> Column:
    """Gaps-and-islands id: increases whenever ``flag`` changes."""
    changed = F.coalesce((c(flag) != F.lag(c(flag)).over(w)).cast("int"), F.lit(1))
    return F.sum(changed).over(w.rowsBetween(Window.unboundedPreceding, 0))


def qcut_edges(df: DataFrame, x: str, q: int = 5, by=("exchange", "symbol", "interval")) -> DataFrame:
    """W10 edges: exact quantile edges of ``x`` per key (one small row per
    key), computed as distributed order statistics."""
    from tidemark.operators.stats import exact_quantiles
    probs = [i / q for i in range(q + 1)]
    names = [f"_e{i}" for i in range(q + 1)]
    e = exact_quantiles(df, list(by), x, probs, names)
    return e.select(*by, F.array(*names).alias("_edges"))


def qcut_bucket(x, edges: Column, q: int = 5) -> Column:
    """Pandas ``qcut``: right-closed bins, the lowest edge included;
    duplicate edges -> NULL (``duplicates='raise'`` produces no buckets)."""
    distinct_ok = F.size(F.array_distinct(edges)) == F.size(edges)
    expr = None
    for i in range(q):
        lo, hi = F.get(edges, i), F.get(edges, i + 1)
        cond = ((c(x) >= lo) if i == 0 else (c(x) > lo)) & (c(x) <= hi)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return F.when(distinct_ok, expr)


def lag_lead(df: DataFrame, cols: dict[str, tuple[str, int]], key=KEY, idx: str = "bar_idx") -> DataFrame:
    """``{out: (col, k)}``; k>0 = lag k rows, k<0 = lead |k| rows."""
    back = max([k for _, k in cols.values() if k > 0], default=0)
    fwd = max([-k for _, k in cols.values() if k < 0], default=0)

    def build(w):
        return {o: (F.lag(x, k) if k > 0 else F.lead(x, -k)).over(w) for o, (x, k) in cols.items()}

    return series.halo_windows(df, build, back=back, fwd=fwd, key=key, idx=idx)
