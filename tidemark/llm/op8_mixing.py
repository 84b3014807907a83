"""Mixing sources to target weights by a time-varying curriculum.

Every source has a weight schedule over training time t in [0, 1], a
piecewise-linear function.  Its integral, scaled to the source's target,
is the source's cumulative token demand; a document whose tokens begin at
demand d is trained at the time the demand function reaches d.  Inverting the
(piecewise quadratic) demand gives every document its position, and a range
sort by position is the training order.

Targets: the weights share ``budget_share`` of all tokens; a source's target
stops at ``max_epochs`` times its size and the excess is shared again among
the others by weight (the water level is found in closed form from the sources
ordered by size / weight).

Nulls and ties: a null text has size 0 (it is returned with ``taken`` 0); a null
source is a source of its own, ordered last; rows that repeat a doc_id, or have a
null one, each count on their own; ties in the order are broken by doc_id and
text, so identical rows are interchangeable and reruns agree.  An empty table
gives an empty plan.  A source without words has target 0.  Columns other than
doc_id, text and source play no part in the plan and are kept by
``training_order``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_RE, materialize, table

WEIGHTS = (5.0, 2.0, 1.0)
BUDGET_SHARE = 1.5
MAX_EPOCHS = 2.0
#: Knots (t, level) of the weight schedules, dealt to the sources in turn: falling, flat and rising.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.8), (1.0, 1.9)))
ROWS_PER_BUCKET = 1_000
MAX_BUCKET_BITS = 24


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, budget_share: float = BUDGET_SHARE,
                   max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, place, weight, target) from (source, size) rows.

    One row per source; the two windows run over that aggregate only (its
    length is the number of sources, not of documents)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.col("place"), F.lit(len(weights))) + 1)
    s = per.withColumn("place", F.row_number().over(order) - 1).withColumn("weight", w)
    s = s.withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
    # Sources in the order in which a rising water level fills them.
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("place"))
    everything = Window.partitionBy()
    s = (s.withColumn("total", F.lit(float(budget_share)) * F.sum("source_size").over(everything))
         .withColumn("full_before", F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("weight_left", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))))
    s = s.withColumn("level", (F.col("total") - F.col("full_before")) / F.col("weight_left"))
    # The level at the first source that it does not fill; all sources are full if there is none.
    s = s.withColumn("final", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("full_before", "level"))).over(everything))
    target = F.least(F.col("cap"), F.coalesce(F.col("final.level") * F.col("weight"), F.col("cap")))
    return s.select("source", "source_size", "place", "weight", target.alias("target"))


def _pieces(knots: Sequence[tuple[float, float]]) -> list[tuple[float, float, float, float, float]]:
    """(t0, t1, level0, slope, share of the integral before t0) per linear piece, integral scaled to 1."""
    area = sum((t1 - t0) * (a + b) / 2 for (t0, a), (t1, b) in zip(knots, knots[1:]))
    out, done = [], 0.0
    for (t0, a), (t1, b) in zip(knots, knots[1:]):
        out.append((t0, t1, a / area, (b - a) / (t1 - t0) / area, done))
        done += (t1 - t0) * (a + b) / 2 / area
    return out


def demand_time(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """The time at which the integral of the schedule reaches ``share`` of its total."""
    out = None
    for t0, t1, level, slope, before in reversed(_pieces(knots)):
        need = F.greatest(share - F.lit(before), F.lit(0.0))
        # level * x + slope / 2 * x^2 = need, in the form that is stable for a slope of zero
        root = F.sqrt(F.greatest(F.lit(level * level) + F.lit(2 * slope) * need, F.lit(0.0)))
        t = F.least(F.lit(t0) + F.coalesce(F.try_divide(F.lit(2.0) * need, F.lit(level) + root), F.lit(0.0)), F.lit(t1))
        out = t if out is None else F.when(share < F.lit(nxt), t).otherwise(out)  # noqa: F821
        nxt = before
    return out


def curriculum(docs: DataFrame, weights: Sequence[float] = WEIGHTS, budget_share: float = BUDGET_SHARE,
               max_epochs: float = MAX_EPOCHS, schedules: Sequence = SCHEDULES,
               rows_per_bucket: int = ROWS_PER_BUCKET, carry: Sequence[Column] = ()) -> DataFrame:
    """One row per document row: doc_id, source, size, source_size, target,
    taken (words the mix takes), passes array<struct<epoch, words, position>>, and
    the ``carry`` expressions over the input row.

    A source is read in rounds: whole rounds while its target lasts, then
    documents in a fixed pseudo-random order (md5 of doc_id and text), the last one cut
    at the target.  The running sums never put a source into one task: the order
    is cut into buckets by the leading md5 bits, their sums (a small aggregate)
    are accumulated per source, and only the inside of a bucket is a window.
    The texts are counted once for the sums and read once more only if ``carry`` asks for them."""
    text_md5 = F.md5(F.coalesce("text", F.lit("")))
    md5 = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text_md5))
    base = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), md5.alias("order"), *carry)
    sized = materialize(base.select("doc_id", "source", "size", "order"), "mix-sizes")
    base = base if carry else sized
    targets = source_targets(sized.select("source", "size"), weights, budget_share, max_epochs)
    bits = min(MAX_BUCKET_BITS, max(4, math.ceil(math.log2(max(1, sized.count()) / rows_per_bucket))))
    bucket = F.shiftright(F.conv(F.substring("order", 1, 7), 16, 10).cast("int"), 28 - bits)
    base, sized = base.withColumn("bucket", bucket), sized.withColumn("bucket", bucket)
    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("source").alias("s2"), F.col("bucket").alias("b2"),
                          F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("offset"))
    offsets = (offsets.join(targets.withColumnRenamed("source", "s3"), F.col("s2").eqNullSafe(F.col("s3")))
               .select("s2", "b2", "offset", "source_size", "target", "place"))
    inside = (Window.partitionBy("source", "bucket").orderBy("order", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    d = base.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    d = (d.join(offsets, F.col("source").eqNullSafe(F.col("s2")) & (F.col("bucket") == F.col("b2")))
         .withColumn("before", F.col("before") + F.col("offset")))

    need = F.floor("target")
    epochs = int(-(-max_epochs // 1))
    passes = []
    for e in range(epochs):
        start = F.lit(e) * F.col("source_size") + F.col("before")
        words = F.least(F.col("size"), F.greatest(need - start, F.lit(0))).cast("long")
        share = F.coalesce(F.try_divide(start.cast("double"), F.col("target")), F.lit(0.0))
        position = None
        for i, knots in enumerate(schedules):
            t = demand_time(share, knots)
            position = t if position is None else F.when(F.pmod(F.col("place"), F.lit(len(schedules))) == i, t).otherwise(position)
        passes.append(F.struct(F.lit(e).alias("epoch"), words.alias("words"), F.least(position, F.lit(1.0)).alias("position")))
    d = d.withColumn("passes", F.filter(F.array(*passes), lambda p: p["words"] > 0))
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda a, p: a + p["words"])
    return d.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "passes",
                    *[c for c in base.columns if c.startswith("_")])


def training_order(docs: DataFrame, **params) -> DataFrame:
    """The mix as training rows, range-sorted by position: the columns of ``docs``
    plus mix_epoch, mix_words and mix_position (which replace columns of those names);
    a document taken twice has two rows.  ``mix_words`` says how many leading words
    of the text the pass takes."""
    kept = [c for c in docs.columns if c not in ("mix_epoch", "mix_words", "mix_position")]
    plan = curriculum(docs, carry=[F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row")], **params)
    out = plan.select("_row", F.explode("passes").alias("_p"))
    out = out.select("_row.*", F.col("_p.epoch").alias("mix_epoch"), F.col("_p.words").alias("mix_words"),
                     F.col("_p.position").alias("mix_position"))
    return out.orderBy("mix_position", "doc_id", "mix_epoch")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document, and the training times of its first and last pass (null: in none)."""
    plan = curriculum(table(spark, sf_dir, "documents"))
    at = F.transform("passes", lambda p: F.round(p["position"], 6))
    return plan.select("doc_id", "size", "source_size", "target", "taken",
                       F.array_min(at).alias("first_position"), F.array_max(at).alias("last_position"))


def _position_sql(start: str) -> str:
    """``demand_time`` of the source's schedule in SQL, for the demand ``start``."""
    num = lambda x: f"'{float(x)!r}'::DOUBLE"
    share = f"coalesce(({start})::DOUBLE / nullif(target, 0), {num(0)})"
    times = []
    for knots in SCHEDULES:
        pieces = _pieces(knots)
        whens = []
        for i, (t0, t1, level, slope, before) in enumerate(pieces):
            need = f"greatest({share} - {num(before)}, {num(0)})"
            root = f"sqrt(greatest({num(level * level)} + {num(2 * slope)} * {need}, {num(0)}))"
            t = f"least({num(t0)} + coalesce({num(2)} * {need} / nullif({num(level)} + {root}, 0), {num(0)}), {num(t1)})"
            whens.append(f"WHEN {share} < {num(pieces[i + 1][4])} THEN {t}" if i + 1 < len(pieces) else f"ELSE {t}")
        times.append(f"CASE {' '.join(whens)} END" if len(pieces) > 1 else whens[0][5:])
    schedules = " ".join(f"WHEN {i} THEN {t}" for i, t in enumerate(times))
    return f"round(least(CASE place % {len(SCHEDULES)} {schedules} END, {num(1)}), 6)"


SQL = r"""
WITH base AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS ord
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM base GROUP BY source),
placed AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM per),
weighed AS (SELECT *, CAST([5, 2, 1][place % 3 + 1] AS DOUBLE) AS weight, 2.0::DOUBLE * source_size AS cap FROM placed),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
         row_number() OVER (ORDER BY cap / weight, place) AS nth
  FROM weighed),
final AS (SELECT level FROM levels WHERE level * weight <= cap ORDER BY nth LIMIT 1),
targets AS (SELECT source, place, source_size, least(cap, coalesce((SELECT level FROM final) * weight, cap)) AS target FROM levels),
cum AS (
  SELECT b.doc_id, b.size, t.source_size, t.target, t.place,
         coalesce(sum(b.size) OVER (PARTITION BY b.source ORDER BY ord, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM base b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (least(size, greatest(floor(target)::BIGINT - before, 0))
        + least(size, greatest(floor(target)::BIGINT - source_size - before, 0)))::BIGINT AS taken,
       CASE WHEN first > 0 THEN p0 WHEN again > 0 THEN p1 END AS first_position,
       CASE WHEN again > 0 THEN p1 WHEN first > 0 THEN p0 END AS last_position
FROM (SELECT *, least(size, greatest(floor(target)::BIGINT - before, 0)) AS first,
             least(size, greatest(floor(target)::BIGINT - source_size - before, 0)) AS again,
             @FIRST@ AS p0, @AGAIN@ AS p1 FROM cum)
""".replace("@FIRST@", _position_sql("before")).replace("@AGAIN@", _position_sql("source_size + before"))

QUERIES = {"op8_mixing": op8_mixing}
ORACLES = {"op8_mixing": SQL}
