"""Quality rules whose thresholds are chosen with a guarantee against false rejection.

A rule rejects a document if a measure of it passes a cutoff; each rule has a fixed list of cutoffs from the strictest to the loosest
(``RULES``).  Which cutoffs hold is decided per stratum (the language in the query) from labelled documents:

1. Half of the labelled documents, by the md5 of their id, propose.  The lift of a cutoff is the share of the poor documents that it
   rejects over that of the good ones (counts of good ones raised by one).  The steps (rule, cutoff) with a lift of ``MIN_LIFT`` or more, as far as a
   rule's list goes without a gap, are put in one order by falling lift: a path of rule sets, each rejecting all that the one before does.
2. The other half tests.  Walking the path, k of the n good holdout documents are rejected so far; the set is accepted if so few would be as
   unlikely as ``delta`` were the true rate over ``limit``: P(Binomial(n, limit) <= k) <= delta / strata.  The walk ends at the first set that
   fails.  Testing nested sets in a fixed order needs no correction inside a stratum, and dividing by the number of strata corrects
   across them, so that with probability 1 - delta no stratum's rate of false rejection is over the limit.
3. All documents are judged by the last accepted set of their stratum.  A stratum without enough good holdout documents rejects nothing.

Documents that fail the base rule (under 20 words, or over 30 % of the words in repeated windows) are out before that and take no
part in the labels' counts, so the guarantee is for good documents that the base rule keeps.

Nulls and ties: a null text has no word and fails the base rule; a null stratum is one of its own; labels with a null id or
quality are left out, of several labels for an id the best counts; rows that repeat an id are each judged but are one
observation (that of the smallest measures); equal lifts are ordered by rule and cutoff; empty tables give no rows; without
labels only the base rule rejects.  Texts are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, packed, table

LIMIT = 0.05
DELTA = 0.05
MIN_LIFT = 10.0
MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
#: (rule, measure, divided by, rejects above or below, cutoffs in percent from the strictest to the loosest).  Fixed values.
RULES = (
    ("symbols", "n_symbols", "n_words", ">", (200, 100, 50, 40, 30, 20, 10, 5)),
    ("long_words", "word_chars", "n_words", ">", (1000, 900, 850, 800, 750, 700, 650, 600)),
    ("short_words", "word_chars", "n_words", "<", (250, 300, 350, 380, 400, 420, 440)),
    ("copied_lines", "n_dup_lines", "n_lines", ">", (70, 50, 40, 30, 20, 10)),
    ("repeats", "n_repeat_words", "n_words", ">", (28, 25, 20, 15, 10, 5)),
    ("few_words", "n_words", None, "<", (2500, 3000, 4000, 5000, 7500, 10000)),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_SYMBOLS = "#*$%&|<>"
_BLANKS = " \t\n\x0b\x0c\r"


# ---------------------------------------------------------------- measures

class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def repeated_words(words: list[bytes], hashes: dict, window: int = WINDOW) -> int:
    """How many words lie in a window that occurs twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    runs = np.full(n, np.uint64(window))
    for i in range(window):
        runs = (runs ^ (runs >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n]
    order = np.argsort(runs, kind="stable")
    same = runs[order][1:] == runs[order][:-1]
    if not same.any():
        return 0
    hit = np.zeros(n, np.int64)
    hit[order[1:][same]] = hit[order[:-1][same]] = 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += hit
    edges[window:window + n] -= hit
    return int((np.cumsum(edges) > 0).sum())


def measure(text: str | None, hashes: dict) -> tuple[int, ...]:
    """The ``MEASURES`` of a text."""
    text = text or ""
    words = text.encode("utf-8", "ignore").split()  # bytes split at the six ASCII white space characters only
    lines = [x for x in text.split("\n") if x.strip(_BLANKS)]
    return (len(words), len(text) - sum(map(text.count, _BLANKS)), sum(map(text.count, _SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(words, hashes), len(lines))


def measured(docs: DataFrame, stratum: Column, *carry: Column) -> DataFrame:
    """doc_id, stratum, the measures, base_failed and the ``carry`` columns of every row."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), stratum.cast("string").alias("stratum"), "text", *carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for b in batches:
            got = np.array([measure(t.as_py(), hashes) for t in b.column(2)], np.int64).reshape(-1, len(MEASURES))
            kept = [0, 1, *range(3, b.num_columns)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in kept), *map(pa.array, got.T)],
                                             [*(b.schema.names[i] for i in kept), *MEASURES])

    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema if f.name != "text"] + [f"{m} long" for m in MEASURES])
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return given.mapInArrow(run, fields).withColumn("base_failed", base)


def rejections() -> Column:
    """array<int>: for every rule that rejects the row at some cutoff, 100 * rule + place of the strictest cutoff that does, from 1."""
    out = []
    for r, (_, m, over, way, cutoffs) in enumerate(RULES):
        den = F.col(over) if over else F.lit(1)
        level = None
        for j, c in reversed(list(enumerate(cutoffs, 1))):
            hit = 100 * F.col(m) > c * den if way == ">" else 100 * F.col(m) < c * den
            level = F.when(hit, 100 * r + j) if level is None else F.when(hit, 100 * r + j).otherwise(level)
        out.append(level)
    return F.array_compact(F.array(*out))


# ---------------------------------------------------------------- bounds

def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= k), as the regularized incomplete beta function I(1 - p; n - k, k + 1), by its continued fraction."""
    if k >= n:
        return 1.0
    if k < 0:
        return 0.0
    a, b, x = float(n - k), float(k + 1), 1.0 - p

    def fraction(a: float, b: float, x: float) -> float:
        """Modified Lentz evaluation, times the leading factor."""
        tiny = 1e-300
        c, d = 1.0, 1.0 / (1.0 - (a + b) * x / (a + 1) or tiny)
        f = d
        for m in range(1, 100_000):
            for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d = 1.0 / (1.0 + num * d or tiny)
                c = 1.0 + num / c or tiny
                f *= c * d
            if abs(c * d - 1.0) < 1e-15:
                break
        front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
        return math.exp(front) * f / a

    return fraction(a, b, x) if x < (a + 1) / (a + b + 2) else 1.0 - fraction(b, a, 1.0 - x)


def thresholds(rows: DataFrame, labels: DataFrame, limit: float = LIMIT, delta: float = DELTA, min_lift: float = MIN_LIFT) -> DataFrame:
    """(stratum, step, rule, cutoff, code, lift, good, rejected, p_value, accepted): the path of every stratum with labels.

    ``rows`` is ``measured``; ``good`` and ``rejected`` count the good holdout documents, all and those that the path has rejected up to the step.
    Everything runs on sums by (stratum, rule, cutoff); a stratum has at most as many steps as there are cutoffs."""
    one = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.max("quality") > 0).alias("good"))
    seen = (rows.where("NOT base_failed AND doc_id IS NOT NULL").select("doc_id", "stratum", *MEASURES).groupBy("doc_id")
            .agg(F.min(F.struct("stratum", *MEASURES)).alias("m")).select("doc_id", "m.*"))
    known = (seen.join(one.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id")
             .select("stratum", "good", (F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1) < "8").alias("proposes"), rejections().alias("codes")))
    known = materialize(known, "rules-labelled")

    # Counts of the proposing half: per stratum one row per cutoff, those without documents too.
    half = known.where("proposes")
    n = half.groupBy("stratum").agg(F.sum(F.col("good").cast("long")).alias("n_good"), F.sum((~F.col("good")).cast("long")).alias("n_poor"))
    grid = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(j).alias("j"), F.lit(name).alias("rule"), F.lit(c).alias("cutoff"))
                     for r, (name, *_, cutoffs) in enumerate(RULES) for j, c in enumerate(cutoffs, 1)])
    cells = n.select("stratum", "n_good", "n_poor", F.inline(grid)).withColumn("code", 100 * F.col("r") + F.col("j"))
    hits = (half.select(F.col("stratum").alias("s"), "good", F.explode("codes").alias("c")).groupBy("s", "c")
            .agg(F.sum(F.col("good").cast("long")).alias("g"), F.sum((~F.col("good")).cast("long")).alias("p")))
    cells = cells.join(hits, F.col("stratum").eqNullSafe(F.col("s")) & (F.col("code") == F.col("c")), "left").na.fill(0, ["g", "p"])
    chain = Window.partitionBy("stratum", "r").orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    poor, good = F.sum("p").over(chain), F.sum("g").over(chain)
    lift = F.when(poor + good > 0, (poor / (F.col("n_poor") + 1)) / ((good + 1) / (F.col("n_good") + 1)))
    # Cutoffs too strict to reject any come with the first that does.
    steps = cells.withColumn("here", lift).withColumn("lift", F.min("here").over(chain))
    steps = steps.withColumn("lift", F.coalesce("lift", F.max("lift").over(Window.partitionBy("stratum", "r")))).where(F.col("lift") >= min_lift)
    steps = steps.withColumn("step", F.row_number().over(Window.partitionBy("stratum").orderBy(F.desc("lift"), "r", "j")))
    steps = materialize(steps.select("stratum", "step", "rule", "cutoff", "code", "lift"), "rules-steps")

    # The testing half: the step at which the path rejects each good document.
    other = known.where("good AND NOT proposes")
    first = _with_path(other, steps).groupBy(F.col("stratum").alias("s"), F.col("first").alias("f")).agg(F.count(F.lit(1)).alias("k"))
    good = first.groupBy("s").agg(F.sum("k").alias("good"))
    strata = max(1, good.count())
    tested = (steps.join(good, F.col("stratum").eqNullSafe(F.col("s")), "left").drop("s")
              .join(first.where("f IS NOT NULL"), F.col("stratum").eqNullSafe(F.col("s")) & (F.col("step") == F.col("f")), "left"))
    walk = Window.partitionBy("stratum").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    tested = tested.withColumn("good", F.coalesce("good", F.lit(0))).withColumn("rejected", F.sum(F.coalesce("k", F.lit(0))).over(walk))

    @F.pandas_udf("double")
    def p_value(k, n):  # noqa: ANN001, ANN202
        return k.combine(n, lambda a, b: binomial_cdf(int(a), int(b), limit))

    tested = tested.withColumn("p_value", p_value("rejected", "good"))
    passes = F.min((F.col("p_value") <= delta / strata).cast("int")).over(walk) == 1
    return tested.select("stratum", "step", "rule", "cutoff", "code", "lift", "good", "rejected", "p_value", passes.alias("accepted"))


def _with_path(rows: DataFrame, steps: DataFrame) -> DataFrame:
    """``rows`` (stratum, codes) with ``first``: the first of the ``steps`` of its stratum that rejects the row, or null.  A stratum's steps are one small row."""
    path = steps.groupBy(F.col("stratum").alias("_s")).agg(F.map_from_entries(F.collect_list(F.struct("code", "step"))).alias("_path"))
    got = rows.join(path, F.col("stratum").eqNullSafe(F.col("_s")), "left")
    return got.withColumn("first", F.array_min(F.transform("codes", lambda c: F.try_element_at("_path", c)))).drop("_s", "_path")


def judged(docs: DataFrame, labels: DataFrame, stratum: Column, *carry: Column, **risk) -> DataFrame:
    """doc_id, stratum, the measures, base_failed, kept and the ``carry`` columns of every row of ``docs``."""
    rows = materialize(measured(docs, stratum, *carry), "rules-measured")
    accepted = materialize(thresholds(rows, labels, **risk).where("accepted").select("stratum", "step", "code"), "rules-accepted")
    out = _with_path(rows.withColumn("codes", rejections()), accepted)
    return out.withColumn("kept", ~F.col("base_failed") & F.col("first").isNull()).drop("codes", "first")


def keep_good(docs: DataFrame, labels: DataFrame, stratum: Column, **risk) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    row = packed(docs, doc_id=F.col("doc_id"), text=F.col("text"), _stratum=stratum)
    return judged(row, labels, F.col("_stratum"), F.col("row"), **risk).where("kept").select("row.*")


def op12_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measures and the verdict of every document, thresholds by language."""
    got = judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("lang"))
    return got.select("doc_id", *MEASURES[:5], "base_failed", "kept")


_GRID = ", ".join(f"({r}, {j}, {c})" for r, (*_, cutoffs) in enumerate(RULES) for j, c in enumerate(cutoffs, 1))
_CODES = ", ".join("CASE " + " ".join(f"WHEN 100 * {m} {way} {c} * {over or 1} THEN {100 * r + j}" for j, c in enumerate(cutoffs, 1)) + " END"
                   for r, (_, m, over, way, cutoffs) in enumerate(RULES))
SQL = rf"""
WITH t AS (SELECT row_number() OVER () AS row, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t),
win AS (SELECT row, i, count(*) OVER (PARTITION BY row, ws[i:i + 7]) AS c FROM w, unnest(range(1, len(ws) - 6)) u(i)),
rep AS (SELECT row, count(DISTINCT p) AS k FROM win, unnest(range(i, i + 8)) v(p) WHERE c > 1 GROUP BY row),
ln AS (SELECT row, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM t)
       WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row),
m AS (SELECT row, doc_id, lang, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines,
             coalesce(k, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_lines
      FROM w LEFT JOIN rep USING (row) LEFT JOIN ln USING (row)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
             list_filter([{_CODES}], lambda x: x IS NOT NULL) AS codes FROM m),
l AS (SELECT doc_id, max(quality) > 0 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
known AS (SELECT lang, good, substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) < '8' AS proposes, codes FROM (
            SELECT * FROM b WHERE NOT base_failed QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines) = 1)
          JOIN l USING (doc_id)),
n AS (SELECT lang, count(*) FILTER (good) AS n_good, count(*) FILTER (NOT good) AS n_poor FROM known WHERE proposes GROUP BY lang),
hits AS (SELECT lang, c, count(*) FILTER (good) AS g, count(*) FILTER (NOT good) AS p FROM known, unnest(codes) u(c) WHERE proposes GROUP BY lang, c),
cells AS (SELECT n.lang, r, j, 100 * r + j AS code, n_good, n_poor,
                 sum(coalesce(p, 0)) OVER ch AS poor, sum(coalesce(g, 0)) OVER ch AS ok
          FROM n CROSS JOIN (VALUES {_GRID}) grid(r, j, cutoff) LEFT JOIN hits ON hits.lang IS NOT DISTINCT FROM n.lang AND hits.c = 100 * r + j
          WINDOW ch AS (PARTITION BY n.lang, r ORDER BY j)),
mins AS (SELECT *, min(CASE WHEN poor + ok > 0 THEN (poor::DOUBLE / (n_poor + 1)) / ((ok + 1)::DOUBLE / (n_good + 1)) END) OVER (PARTITION BY lang, r ORDER BY j) AS low FROM cells),
lifts AS (SELECT *, coalesce(low, max(low) OVER (PARTITION BY lang, r)) AS lift FROM mins),
steps AS (SELECT lang, code, row_number() OVER (PARTITION BY lang ORDER BY lift DESC, r, j) AS step FROM lifts WHERE lift >= {MIN_LIFT}),
other AS (SELECT row_number() OVER () AS d, lang, codes FROM known WHERE good AND NOT proposes),
sizes AS (SELECT lang, count(*) AS n FROM other GROUP BY lang),
firsts AS (SELECT lang, f, count(*) AS k FROM (SELECT o.d, o.lang, min(step) AS f FROM other o, unnest(o.codes) u(c) JOIN steps s ON s.lang IS NOT DISTINCT FROM o.lang AND s.code = c
           GROUP BY ALL) GROUP BY lang, f),
tested AS (SELECT s.lang, s.code, s.step, coalesce(n, 0) AS n, sum(coalesce(k, 0)) OVER (PARTITION BY s.lang ORDER BY s.step) AS k
           FROM steps s LEFT JOIN sizes z ON z.lang IS NOT DISTINCT FROM s.lang LEFT JOIN firsts f ON f.lang IS NOT DISTINCT FROM s.lang AND f.f = s.step),
bounds AS (SELECT *, CASE WHEN k >= n THEN 1 ELSE list_sum(list_transform(range(k::BIGINT + 1),
             lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({LIMIT}) + (n - i) * ln(1 - {LIMIT})))) END AS p FROM tested),
accepted AS (SELECT lang, code FROM (SELECT *, min((p <= {DELTA} / (SELECT greatest(count(*), 1) FROM sizes))::INT) OVER (PARTITION BY lang ORDER BY step) AS ok FROM bounds) WHERE ok = 1),
gone AS (SELECT DISTINCT row FROM (SELECT row, lang, unnest(codes) AS code FROM b) x JOIN accepted a ON a.lang IS NOT DISTINCT FROM x.lang AND a.code = x.code)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND gone.row IS NULL AS kept
FROM b LEFT JOIN gone USING (row)
"""

QUERIES = {"op12_rules": op12_rules}
ORACLES = {"op12_rules": SQL}
