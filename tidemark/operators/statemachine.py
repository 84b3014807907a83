"""Sequential per-series state machines without whole-key tasks.

Chart scripts keep ``var`` state per symbol and update it bar by bar
(locked ranges, one-position trading).  Such a scan is sequential, but its
state forgets the past: whenever two runs are in the same state at the same
bar they agree from then on.  ``block_scan`` uses that:

1. Every block of ``bar_idx`` (``series.block_rows``) is run independently,
   starting from the machine's initial state ``halo`` rows *before* the
   block (halo rows are copied from the previous block).
2. A block is accepted when its speculative state after some halo row equals
   the previous block's own state after that row; if the previous block is
   correct, so is this one (block 0 starts at the series start and is exact).
3. Blocks that are not accepted are re-run from the exact end state of their
   (correct) predecessor, round by round, until every block is correct.
   With a halo longer than the machine's memory this loop does no work.

The machine is a small Python object (``initial``, ``step``); it sees one
block's rows as numpy arrays, so no task ever holds more than one block.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import series
from tidemark.operators.joins import null_safe_join
from tidemark.schemas import KEY
from tidemark.session import cut_lineage


class Machine:
    """Interface: ``initial() -> dict``; ``step(state, row) -> list[dict]``
    mutates ``state`` in place for one row (a dict of input values) and
    returns the events the row produces (dicts matching ``event_fields``)."""

    event_fields: Sequence[tuple[str, T.DataType]] = ()

    def initial(self) -> dict:
        raise NotImplementedError

    def step(self, state: dict, row: dict) -> list[dict]:
        raise NotImplementedError


def _sig(state: dict) -> str:
    return json.dumps(state, sort_keys=True, default=float, allow_nan=True)


def _out_schema(key_fields, machine: Machine) -> T.StructType:
    f = list(key_fields) + [T.StructField("_blk", T.LongType()), T.StructField("_kind", T.StringType()),
                            T.StructField("bar_idx", T.LongType()), T.StructField("_sig", T.StringType())]
    f += [T.StructField(n, t) for n, t in machine.event_fields]
    return T.StructType(f)


def _runner(machine: Machine, key: list[str], in_cols: list[str], schema: T.StructType, halo: int, b: int):
    names = [fl.name for fl in schema.fields]
    ev_names = [n for n, _ in machine.event_fields]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bar_idx", kind="stable").reset_index(drop=True)
        kv = {k: pdf[k].iloc[0] for k in key}
        blk = int(pdf["_blk"].iloc[0])
        init = pdf["_init"].iloc[0] if "_init" in pdf.columns else None
        state = json.loads(init) if isinstance(init, str) else machine.initial()
        cols = {c: pdf[c].to_numpy() for c in in_cols}
        idxs, cores = pdf["bar_idx"].to_numpy(), pdf["_core"].to_numpy()
        rows = []
        last_core = None
        core_end = (blk + 1) * b
        for i in range(len(pdf)):
            r = {c: cols[c][i] for c in in_cols}
            r["bar_idx"] = int(idxs[i])
            evs = machine.step(state, r)
            ix = int(idxs[i])
            if cores[i]:
                for e in evs:
                    rows.append({**kv, "_blk": blk, "_kind": "event", "bar_idx": ix, "_sig": None, **e})
                if ix >= core_end - halo:
                    rows.append({**kv, "_blk": blk, "_kind": "own", "bar_idx": ix, "_sig": _sig(state)})
                last_core = ix
            else:
                rows.append({**kv, "_blk": blk, "_kind": "spec", "bar_idx": ix, "_sig": _sig(state)})
        if last_core is not None:
            rows.append({**kv, "_blk": blk, "_kind": "end", "bar_idx": last_core, "_sig": _sig(state)})
        if not rows:
            return series.pandas_frame({n: [] for n in names}, schema)
        out = pd.DataFrame(rows)
        for n in ev_names:
            if n not in out.columns:
                out[n] = None
        return series.pandas_frame({n: out[n].tolist() for n in names}, schema)

    return run


def block_scan(df: DataFrame, machine: Machine, in_cols: Sequence[str], halo: int = 2000,
               key: Sequence[str] = KEY) -> DataFrame:
    """Run ``machine`` over each key's rows in ``bar_idx`` order; returns one
    row per event: key, ``bar_idx`` and the machine's event fields."""
    key, in_cols = list(key), list(in_cols)
    b = series.block_rows(df)
    halo = min(halo, b)
    ktypes = {f.name: f.dataType for f in df.schema.fields}
    schema = _out_schema([T.StructField(k, ktypes[k]) for k in key], machine)
    base = df.select(*key, "bar_idx", *in_cols)
    x = series._halo_explode(base, "bar_idx", halo, 0, b)
    out = x.groupBy(*key, "_blk").applyInPandas(_runner(machine, key, in_cols, schema, halo, b), schema)
    out = cut_lineage(out)

    left = None
    while True:  # rounds; each makes at least one block of every open key exact
        bad = cut_lineage(_unverified(out, key))
        first_bad = bad.groupBy(*key).agg(F.min("_blk").alias("_blk"))
        open_ = bad.count()
        if not open_:
            break
        if left is not None and open_ >= left:
            raise RuntimeError(f"{open_} blocks stay unverified")
        left = open_
        # exact rerun of the first unverified block of each key from its predecessor's end state
        ends = out.where(F.col("_kind") == "end").select(*key, (F.col("_blk") + 1).alias("_blk"),
                                                         F.col("_sig").alias("_init"))
        mine = base.withColumn("_blk", F.floor(F.col("bar_idx") / F.lit(b)).cast("long")).withColumn("_core", F.lit(True))
        rerun_in = null_safe_join(null_safe_join(mine, first_bad, [*key, "_blk"]), ends, [*key, "_blk"])
        redo = rerun_in.groupBy(*key, "_blk").applyInPandas(_runner(machine, key, in_cols + [], schema, halo, b),
                                                           schema)
        # keep the old speculative halo signatures of the rerun block (they are its link to the
        # predecessor, now irrelevant) and replace everything else it produced
        marked = null_safe_join(out, first_bad.withColumn("_redo", F.lit(True)), [*key, "_blk"], "left")
        keep = marked.where("_redo IS NULL OR _kind = 'spec'").drop("_redo")
        out = cut_lineage(keep.unionByName(redo))
        # the rerun block is exact: mark it by giving it a self-verifying spec row
        out = out.unionByName(_verified_marks(first_bad, schema, key))
    ev = out.where(F.col("_kind") == "event")
    return ev.select(*key, "bar_idx", *[n for n, _ in machine.event_fields])


def _verified_marks(blocks: DataFrame, schema: T.StructType, key: list[str]) -> DataFrame:
    cols = []
    for f in schema.fields:
        if f.name in key or f.name == "_blk":
            cols.append(F.col(f.name))
        elif f.name == "_kind":
            cols.append(F.lit("exact").alias("_kind"))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return blocks.select(*cols)


def _unverified(out: DataFrame, key: list[str]) -> DataFrame:
    """Blocks not known to be correct: not block 0, not rerun exactly, and
    either no halo row agrees with the predecessor or the predecessor is
    itself not correct."""
    blocks = out.select(*key, "_blk").distinct()
    spec = out.where(F.col("_kind") == "spec").select(*key, "_blk", "bar_idx", "_sig")
    own = out.where(F.col("_kind") == "own").select(*key, (F.col("_blk") + 1).alias("_blk"), "bar_idx", "_sig")
    synced = null_safe_join(spec, own, [*key, "_blk", "bar_idx", "_sig"]).select(*key, "_blk").distinct().withColumn("_ok", F.lit(1))
    exact = out.where(F.col("_kind") == "exact").select(*key, "_blk").distinct().withColumn("_ex", F.lit(1))
    st = null_safe_join(null_safe_join(blocks, synced, [*key, "_blk"], "left"), exact, [*key, "_blk"], "left")
    ok = F.when((F.col("_blk") == 0) | (F.col("_ex") == 1) | (F.col("_ok") == 1), 1).otherwise(0)
    w = Window.partitionBy(*key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, 0)
    # a verified block after an exact rerun counts from that rerun on: correct = all ok up to here
    st = st.withColumn("_good", F.min(ok).over(w))
    return st.where(F.col("_good") == 0).select(*key, "_blk")
