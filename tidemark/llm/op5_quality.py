"""Quality classifier: document evidence and hierarchical empirical Bayes over sites.

Two targets, low quality and toxic, each with a logistic model over word evidence and text shape:

1. A bounded sample of labelled documents (``LABELLED`` rows, those with the smallest md5 of their
   id) gives, per word, the documents of each class that hold it; the ``LEXICON`` words whose counts are least likely under
   the base rate (signed root of the likelihood ratio) are the model's words.
2. A document's features are measures of its form and, per target, its strongest word evidences. Words seen once or twice
   weigh little by themselves; in training a document's own count is left out, so that chance words get no weight.  A
   logistic regression is trained on the sample (Spark ML).
3. All documents are scored whole, in one scan.
4. Sites: the mean evidence of a host is shrunk toward the global mean, that of a path toward its host;
   the prior strengths are moment estimates from the spread between hosts (and between paths). The sums are grouped
   aggregates over all documents.  A document's posterior log-odds are its own evidence plus ``SITE_WEIGHT`` times the
   log-odds by which its site, without the document itself, differs from the global prior.

A document is accepted if both posteriors are under one half.

Nulls and ties: a null text is empty and scored by its shape; a null host or path is a site of its own; rows with
a null doc_id are scored but never labelled; rows that repeat a doc_id are each scored (and each count for their site); labels that are
null are left out, of several labels for one id the largest counts; without both classes among the labels a target has no evidence
and rejects nothing; an empty table gives no rows; other columns are kept by ``accepted``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, packed, table

LABELLED = 20_000
LEXICON = 20_000
TOP_WORDS = 3
SITE_WEIGHT = 0.5
MIN_WORD_DOCS = 2
TARGETS = ("low", "toxic")
_WORD = re.compile(r"\w+")
SHAPE = ("log_words", "symbol_tokens", "symbol_ends", "upper", "digits", "word_length", "distinct", "top_word", "longest_run",
         "bang_tokens", "line_words", "copied_lines", "short_lines", "letters", "doubled")


def shape(text: str, words: list[str]) -> list[float]:
    """Measures of the text's form, most in [0, 1]."""
    tokens = text.split()
    n, w, c = max(1, len(tokens)), max(1, len(words)), max(1, len(text))
    symbols = sum(not t[-1].isalnum() and not t[-1] in ".,;:!?)\"'" for t in tokens)
    alone = sum(not any(map(str.isalnum, t)) for t in tokens if len(t) < 4)
    upper = sum(map(str.isupper, tokens))
    counts = Counter(words)
    run = longest = doubled = 0
    before = None
    for x in words:
        run = run + 1 if x == before else 1
        doubled += run > 1
        before = x
        longest = max(longest, run)
    lines = [x for x in text.split("\n") if x.strip()]
    m = max(1, len(lines))
    return [math.log1p(len(words)), alone / n, symbols / n, upper / n, sum(t.isdigit() for t in tokens) / n,
            sum(map(len, words)) / w / 10, len(counts) / w, max(counts.values(), default=0) / w, math.log1p(longest),
            sum(t.endswith("!") for t in tokens) / n, math.log1p(w / m), 1 - len(set(lines)) / m,
            sum(len(x) < 20 for x in lines) / m, sum(map(len, words)) / c, doubled / w]


def evidence(yes: float, no: float, base: float) -> float:
    """Signed root of the likelihood ratio of ``yes`` of ``yes + no`` against the base rate; 0 for one without documents."""
    n = yes + no
    if n <= 0:
        return 0.0
    g = (yes * math.log(yes / (n * base)) if yes else 0.0) + (no * math.log(no / (n * (1 - base))) if no else 0.0)
    return math.copysign(math.sqrt(max(0.0, 2 * g)), yes - n * base)


def word_evidence(lexicon: dict) -> dict:
    """{target: {word: evidence}} of a lexicon, for texts that are not counted in it."""
    return {t: {w: evidence(y, n, base) for w, (y, n) in counts.items()} for t, (base, counts) in lexicon.items()}


def features(text: str | None, lexicon: dict, own: dict | None = None, known: dict | None = None) -> list[float]:
    """The shape measures, then for each target the strongest evidences of the text's words and their sum.

    ``lexicon``: {target: (base rate, {word: (yes, no)})}; ``own``: the labels by which the text itself is counted
    there; ``known``: the words' evidences if the text is not counted (``word_evidence``)."""
    text = text or ""
    words = _WORD.findall(text.lower())
    out, present = shape(text, words), set(words)
    for t in TARGETS:
        base, counts = lexicon[t]
        if known is not None:
            found = sorted(map(known[t].__getitem__, known[t].keys() & present), reverse=True)
        else:
            label = (own or {}).get(t)
            found = sorted((evidence(y - (label == 1), n - (label == 0), base) for y, n in map(counts.__getitem__, counts.keys() & present)), reverse=True)
        top = [max(x, 0.0) for x in found[:TOP_WORDS]]
        out += top + [0.0] * (TOP_WORDS - len(top)) + [sum(x for x in found if x > 3)]
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """(text, low, toxic) of the sample; ``limit`` labels at most are sent to the scan."""
    one = (labels.where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)")
           .groupBy("doc_id").agg((1 - F.min("quality")).cast("int").alias("low"), F.max("toxic").cast("int").alias("toxic")))
    few = one.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(limit)
    few = materialize(few.select(F.col("doc_id").alias("_id"), "low", "toxic"), "labels")  # limit rows of 16 bytes
    return materialize(docs.select("doc_id", "text").join(F.broadcast(few), F.col("doc_id") == F.col("_id")).select("text", "low", "toxic"), "labelled")


def pick_lexicon(sample: DataFrame, target: str, size: int) -> tuple[float, dict[str, tuple[int, int]]]:
    """(base rate, {word: (documents with the label, without)}) of the ``size`` words that speak most for or against the label."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got: dict[bool, Counter] = {False: Counter(), True: Counter()}
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got[y == 1].update(set(_WORD.findall((t or "").lower())))
            every = list(got[True].keys() | got[False].keys())
            yield pa.RecordBatch.from_arrays([pa.array(every, pa.string()), pa.array([got[True][w] for w in every], pa.int64()),
                                              pa.array([got[False][w] for w in every], pa.int64())], ["word", "yes", "no"])

    rows = sample.where(F.col(target).isNotNull()).select("text", target)
    totals = rows.agg(F.sum((F.col(target) == 1).cast("long")), F.count(F.lit(1))).first()
    yes, every = totals[0] or 0, totals[1] or 0
    if not yes or yes == every:
        return 0.5, {}
    words = (rows.mapInArrow(count, "word string, yes long, no long").groupBy("word").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
             .where(F.col("yes") + F.col("no") >= MIN_WORD_DOCS))
    base, n = yes / every, F.col("yes") + F.col("no")
    part = lambda k, rate: F.when(k > 0, k * F.log(k / (n * rate))).otherwise(0.0)
    best = words.orderBy((part(F.col("yes"), base) + part(F.col("no"), 1 - base)).desc(), "word").limit(size)
    return base, {r["word"]: (r["yes"], r["no"]) for r in best.collect()}


def train(docs: DataFrame, labels: DataFrame, lexicon_size: int = LEXICON) -> dict:
    """The lexicon and {target: (intercept, weights)}; a target without both classes has no weights."""
    sample = labelled_sample(docs, labels)
    lexicon = {t: pick_lexicon(sample, t, lexicon_size) for t in TARGETS}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [dict(zip(TARGETS, y)) for y in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            x = [features(t.as_py(), lexicon, y) for t, y in zip(b.column(0), own)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column(1), b.column(2)], ["x", *TARGETS])

    rows = sample.select("text", *TARGETS).coalesce(8).mapInArrow(measure, "x array<double>, low int, toxic int")
    rows = materialize(rows, "labelled-features").select(array_to_vector("x").alias("features"), *TARGETS)
    models: dict = {}
    for t in TARGETS:
        known = rows.where(F.col(t).isNotNull()).withColumn("label", F.col(t).cast("double"))
        if known.select("label").distinct().count() < 2:
            models[t] = None
            continue
        fit = LogisticRegression(maxIter=100, regParam=1e-4, elasticNetParam=0.0).fit(known)
        models[t] = (float(fit.intercept), [float(x) for x in fit.coefficients])
    return {"lexicon": lexicon, "models": models}


def score(docs: DataFrame, model: dict, host: Column, path: Column) -> DataFrame:
    """(doc_id, row_key, host, path, low, toxic): the models' probabilities for every row."""
    lexicon, models = model["lexicon"], model["models"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_evidence(lexicon)
        for b in batches:
            out = {t: [] for t in TARGETS}
            for text in b.column(4):
                x = features(text.as_py(), lexicon, known=known)
                for t in TARGETS:
                    if models[t] is None:
                        out[t].append(None)
                        continue
                    bias, w = models[t]
                    z = bias + sum(a * v for a, v in zip(w, x))
                    out[t].append(1 / (1 + math.exp(-min(30.0, max(-30.0, z)))))
            yield pa.RecordBatch.from_arrays([*b.columns[:4], *[pa.array(out[t], pa.float64()) for t in TARGETS]],
                                             ["doc_id", "row_key", "host", "path", *TARGETS])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"),
                       host.cast("string").alias("host"), path.cast("string").alias("path"), "text")
    return rows.mapInArrow(run, "doc_id long, row_key string, host string, path string, low double, toxic double")


def row_key() -> Column:
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), F.hex(F.xxhash64("text")))


def site_posteriors(scored: DataFrame) -> DataFrame:
    """``scored`` with p_<target> (posterior) and host_<target>, path_<target> (site rates without the row itself)."""
    sums = [F.sum(t).alias(f"s_{t}") for t in TARGETS]
    paths = scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), *sums)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), *[F.sum(f"s_{t}").alias(f"hs_{t}") for t in TARGETS])
    # Moments over the site aggregates: means weighted by rows, variance between groups less that of a mean's noise.
    g = hosts.agg(F.sum("hn").alias("gn"), *[F.sum(f"hs_{t}").alias(f"gs_{t}") for t in TARGETS], F.count(F.lit(1)).alias("hosts"),
                  *[F.sum(F.col(f"hs_{t}") * F.col(f"hs_{t}") / F.col("hn")).alias(f"gq_{t}") for t in TARGETS]).first()
    q = paths.agg(F.count(F.lit(1)).alias("paths"), *[F.sum(F.col(f"s_{t}") * F.col(f"s_{t}") / F.col("n")).alias(f"pq_{t}") for t in TARGETS]).first()
    n = g["gn"] or 0
    site = paths.withColumnRenamed("host", "_h").withColumnRenamed("path", "_p")
    out = scored.join(site, F.col("host").eqNullSafe(F.col("_h")) & F.col("path").eqNullSafe(F.col("_p"))).drop("_h", "_p")
    out = out.join(hosts.withColumnRenamed("host", "_host"), F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    for t in TARGETS:
        mean = min(max((g[f"gs_{t}"] or 0.0) / max(1, n), 1e-4), 1 - 1e-4)
        noise = mean * (1 - mean)
        def kappa(squares, groups, within):
            """mean(1 - mean) / between-group variance - 1, bounded."""
            between = max(0.0, (squares - within) / max(1, n) - noise * max(0, groups - 1) / max(1, n))
            return min(max(noise / between - 1, 1.0), 1e6) if between > 0 else 1e6
        k_host = kappa(g[f"gq_{t}"] or 0.0, g["hosts"] or 0, n * mean * mean)
        k_path = kappa(q[f"pq_{t}"] or 0.0, (q["paths"] or 0) - (g["hosts"] or 0), g[f"gq_{t}"] or 0.0)
        own = F.coalesce(F.col(t), F.lit(0.0))
        host = (F.col(f"hs_{t}") - own + k_host * mean) / (F.col("hn") - 1 + k_host)
        path = (F.col(f"s_{t}") - own + k_path * host) / (F.col("n") - 1 + k_path)
        logit = lambda p: F.log(p / (1 - p))
        inside = lambda p: F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
        z = logit(inside(F.col(t))) + SITE_WEIGHT * (logit(inside(path)) - math.log(mean / (1 - mean)))
        out = (out.withColumn(f"host_{t}", host).withColumn(f"path_{t}", path)
               .withColumn(f"p_{t}", F.coalesce(1 / (1 + F.exp(-z)), F.lit(0.0))))
    return out.withColumn("accepted", (F.col("p_low") < 0.5) & (F.col("p_toxic") < 0.5))


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    scored = materialize(score(docs, train(docs, labels), host, path), "scores")
    return site_posteriors(scored)


def accepted(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """``docs`` without the documents that the classifier rejects."""
    bad = classify(docs, labels, host, path).where("NOT accepted").select("row_key").distinct()
    return packed(docs, row_key=row_key()).join(bad, "row_key", "left_anti").select("row.*")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posteriors and decision for every document; its source is the host, its language the path."""
    got = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))
    return got.select("doc_id", "host", "path", "low", "toxic", "host_low", "path_low", "host_toxic", "path_toxic", "p_low", "p_toxic", "accepted")


QUERIES = {"op5_quality": op5_quality}
ORACLES: dict[str, str] = {}
