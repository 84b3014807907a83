"""First touch without a horizon: a tree of extremes over the bars of each series.

"The first later bar whose high reaches a level or whose low falls to one" has no bound on how far away it is.  A
tree answers it in logarithmic time: a node of level l covers ``fanout ** l`` bars and holds their highest high and lowest low.
The search climbs: in each node it looks at the children from its own place on, and goes to the parent's next sibling if none of them holds
a touch.  It then descends in the first child that does.  Every step of all searches is one equi-join on (series, node),
and a search meets at most ``2 * fanout`` children per level, whether it ends on the next bar, far away or never.

NULL keys are series of their own.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import null_safe_join
from tidemark.session import cut_lineage

FANOUT = 32


def extreme_tree(bars: DataFrame, key: Sequence[str], idx: str, high: str, low: str, fanout: int = FANOUT) -> tuple[DataFrame, int]:
    """(key, level, node, kids array<struct<id, hi, lo>>) and the number of levels.

    The children of a node of level 1 are bars.  NaN counts as missing, as it touches nothing."""
    key = list(key)
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    row = bars.select(*key, F.col(idx).cast("long").alias("_id"), number(high).alias("_hi"), number(low).alias("_lo"))
    last = bars.agg(F.max(F.col(idx).cast("long"))).first()[0]
    levels = max(1, math.ceil(math.log((last or 0) + 1, fanout) - 1e-9))
    while fanout ** levels <= (last or 0):  # rounding of the logarithm
        levels += 1
    out = None
    for level in range(1, levels + 1):
        nodes = row.groupBy(*key, F.floor(F.col("_id") / F.lit(fanout)).cast("long").alias("_node")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("_id").alias("id"), F.col("_hi").alias("hi"), F.col("_lo").alias("lo")))).alias("_kids"),
            F.max("_hi").alias("_hi"), F.min("_lo").alias("_lo"))
        nodes = cut_lineage(nodes)
        this = nodes.select(*key, F.lit(level).alias("_level"), "_node", "_kids")
        out = this if out is None else out.unionByName(this)
        row = nodes.select(*key, F.col("_node").alias("_id"), "_hi", "_lo")
    return out, levels


def first_touch(entries: DataFrame, bars: DataFrame, key: Sequence[str], start: str, up: Column | None, down: Column | None,
                idx: str = "bar_idx", high: str = "high", low: str = "low", strict: bool = False, fanout: int = FANOUT) -> DataFrame:
    """``entries`` with ``_hit`` (the first bar at or after ``start`` with high >= ``up`` or low <= ``down``; ``strict``: beyond
    them), ``_hit_high`` and ``_hit_low``, all NULL where there is none.  A NULL level is never touched."""
    key = list(key)
    tree, levels = extreme_tree(bars, key, idx, high, low, fanout)
    none = F.lit(None).cast("double")
    d = entries.withColumns({"_up": (none if up is None else up).cast("double"), "_dn": (none if down is None else down).cast("double"),
                             "_at": F.greatest(F.col(start).cast("long"), F.lit(0)), "_found": F.lit(0)})

    def touched(kid: Column) -> Column:
        above = kid["hi"] > F.col("_up") if strict else kid["hi"] >= F.col("_up")
        below = kid["lo"] < F.col("_dn") if strict else kid["lo"] <= F.col("_dn")
        return F.coalesce(above, F.lit(False)) | F.coalesce(below, F.lit(False))

    def look(d: DataFrame, level: int, node: Column, searching: Column, from_id: Column) -> DataFrame:
        """``_kid``: the first child of ``node`` from ``from_id`` on that holds a touch, for the rows that search on this level."""
        side = tree.where(F.col("_level") == level).select(*key, F.col("_node").alias("_n"), "_kids")
        d = null_safe_join(d.withColumn("_n", F.when(searching, node)), side, [*key, "_n"], "left")
        kid = F.get(F.filter("_kids", lambda k: (k["id"] >= from_id) & touched(k)), 0)
        return d.withColumn("_kid", kid).drop("_n", "_kids")

    # Up: ``_at`` is the place of the search among the children of this level, ``_found`` the level where a touch was seen.
    for level in range(1, levels + 1):
        node, searching = F.floor(F.col("_at") / F.lit(fanout)).cast("long"), F.col("_found") == 0
        d = look(d, level, node, searching, F.col("_at"))
        d = d.withColumns({"_found": F.when(searching & F.col("_kid").isNotNull(), level).otherwise(F.col("_found")),
                           "_at": F.when(searching, F.coalesce(F.col("_kid.id"), node + 1)).otherwise(F.col("_at")),
                           "_last": F.col("_kid") if level == 1 else F.coalesce("_kid", "_last")}).drop("_kid")
    d = cut_lineage(d)
    # Down: from the child seen on level ``_found`` to the bar.
    for level in range(levels - 1, 0, -1):
        d = look(d, level, F.col("_at"), F.col("_found") > level, F.lit(0))
        d = d.withColumns({"_at": F.coalesce(F.col("_kid.id"), F.col("_at")), "_last": F.coalesce("_kid", "_last")}).drop("_kid")
    hit = F.col("_found") > 0
    return d.withColumns({"_hit": F.when(hit, F.col("_at")), "_hit_high": F.when(hit, F.col("_last.hi")),
                          "_hit_low": F.when(hit, F.col("_last.lo"))}).drop("_up", "_dn", "_at", "_found", "_last")
