"""Spelling variants grouped by a variable-length gram index.

Words of all documents are linked if they differ by exactly one inserted, deleted or replaced code point; a word's form is
its most frequent near word, if that is frequent enough, and its root is where following the forms ends.

1. Gram dictionary (``gram_dictionary``): the substrings of the bordered words are counted.  Grams of two code points are always
   in; a gram that occurs more often than ``threshold`` is extended by one code point, and its rarest extensions, as many as stay
   under the threshold together, are pruned again.  So frequent passages get long grams and rare ones short grams.
2. Decomposition (``Grams.cut``): at every place the longest gram of the dictionary that fits, left out if an earlier one covers it.
3. Affected grams (``Grams.affected``): for every place of a word, how many of its grams one edit there may change: those
   that hold the place, those to its left that the dictionary might extend as far, and those to its right that such a gram might cover.
   The worst place bounds the word: two near words share at least (grams - affected) grams, at the same distance from the
   start or one further in the longer word.  With grams of at most half the bordered word that is never less than one.
4. List merging (``near_words``): in one order, rarest gram first, near words share a gram among the first (affected + 1) of either.
   Only these are indexed, by gram, word length and place; lists of one key are joined and each pair is verified.
   A key held by more than ``HOT`` words, by an estimate from a sample of them, is dealt over salts.

A dictionary built from other counts, or another threshold, changes the lists and never the result.

Nulls and ties: null and empty texts have no word; a null doc_id counts as the empty string in the hash that
drops a letter; repeated rows each count; ties of the form go to the smallest word in code-point order; empty tables give no
rows; other columns are ignored.  Texts are read whole.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import drop_table, materialize, partitions, table

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
DROP_EVERY = 31
SHORTEST = 2
LONGEST = 6
THRESHOLD = 500
#: Most entries of the dictionary that goes to every task (some 5 MB); the threshold doubles until it fits.
MAX_GRAMS = 200_000
HOT = 4096
#: Words from which the size of the lists is estimated, and the most lists that are dealt over salts.
SAMPLE_WORDS = 100_000
MAX_HOT = 50_000
SALT = 0x1E3779B97F4A7C15
START, END = "\x01", "\x02"
_RUN = re.compile("[A-Za-zÀ-ÿ]+")


# ---------------------------------------------------------------- words

def misspelt(doc_id, run: bytes) -> str:
    """The lower-cased run, one code point dropped where the hash of document and run says so."""
    h = zlib.crc32(run, zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()))
    word = run.decode()
    if h % DROP_EVERY:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the distinct words that are long and frequent enough; counts are combined in the task first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out():
            rows = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return rows

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                t = t.as_py()
                if not t:
                    continue
                runs = Counter(_RUN.findall(t.encode("utf-8", "ignore").lower().decode()))  # bytes.lower changes A-Z only
                for run, n in runs.items():
                    if len(run) >= min_length:
                        word = misspelt(i, run.encode())
                        if len(word) >= min_length:
                            held[word] += n
                if len(held) > 150_000:
                    yield out()
        if held:
            yield out()

    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "word string, n long")
    return some.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---------------------------------------------------------------- grams

def gram_counts(words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(gram, f): how often each gram of ``SHORTEST`` to ``longest`` code points occurs in the bordered words."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out():
            rows = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["gram", "f"])
            held.clear()
            return rows

        for b in batches:
            for w in b.column(0).to_pylist():
                s = START + w + END
                for q in range(SHORTEST, longest + 1):
                    held.update([s[i:i + q] for i in range(len(s) - q + 1)])
                if len(held) > 250_000:
                    yield out()
        if held:
            yield out()

    return words.select("word").mapInArrow(count, "gram string, f long").groupBy("gram").agg(F.sum("f").alias("f"))


def gram_dictionary(words: DataFrame, longest: int = LONGEST, threshold: int = THRESHOLD, max_grams: int = MAX_GRAMS) -> dict[str, int]:
    """{gram: occurrences}: all shortest grams, and the extensions of frequent ones that pruning leaves.

    A gram has at most one extension per letter of the alphabet, so the window below holds some 90 rows at most."""
    counts = materialize(gram_counts(words, longest), "spelling-grams")
    rarest = Window.partitionBy("parent").orderBy("f", "gram").rowsBetween(Window.unboundedPreceding, 0)
    longer = counts.where(F.length("gram") > SHORTEST).withColumn("parent", F.expr("substring(gram, 1, length(gram) - 1)"))
    while True:
        frequent = counts.where(F.col("f") > threshold).select(F.col("gram").alias("parent"))
        kept = (longer.join(frequent, "parent").withColumn("upto", F.sum("f").over(rarest)).where(F.col("upto") > threshold).select("gram", "f")
                .unionByName(counts.where(F.length("gram") == SHORTEST)))
        # Never more than the bound reaches the driver.
        rows = kept.limit(max_grams + 1).collect()
        if len(rows) <= max_grams:
            drop_table(counts)
            return {r["gram"]: r["f"] for r in rows}
        threshold *= 2


class Grams:
    """Decomposition of words by a dictionary, and how many grams an edit affects."""

    def __init__(self, dictionary: dict[str, int]):
        self.f = dictionary
        #: For each beginning of a gram, the longest gram that begins so.
        self.below: dict[str, int] = {}
        for g in dictionary:
            for k in range(len(g)):
                if self.below.get(g[:k], 0) < len(g):
                    self.below[g[:k]] = len(g)

    def cut(self, s: str, longest: int) -> list[tuple[int, int]]:
        """The (start, end) of the grams of the bordered word ``s``."""
        out, top, n, f = [], 0, len(s), self.f
        for p in range(n - SHORTEST + 1):
            e = min(p + longest, n)
            while e > p + SHORTEST and s[p:e] not in f:
                e -= 1
            if e > top:
                out.append((p, e))
                top = e
        return out

    def affected(self, s: str, grams: list[tuple[int, int]], longest: int) -> int:
        """The most grams that one edit may change, over all places between the borders.

        A gram that starts at p <= i can change by an edit at i only if the dictionary goes on after s[p:i]; let ``low`` be the
        first such p, and ``reach`` the furthest such a gram may end after the edit, in places of ``s`` (one further for a deletion).
        Grams before ``low`` and grams beyond i that end after ``reach`` stay what they are."""
        worst, below = 0, self.below
        starts, ends = [p for p, _ in grams], [e for _, e in grams]  # both ascend
        for i in range(1, len(s)):
            low, reach = i, i + min(longest, max(SHORTEST, below.get("", 0)))
            for p in range(max(0, i - longest + 1), i):
                m = min(longest, max(SHORTEST, below.get(s[p:i], 0)))
                if m > i - p:
                    low = min(low, p)
                    reach = max(reach, p + m + 1)
            worst = max(worst, max(bisect_right(starts, i), bisect_right(ends, reach)) - bisect_left(starts, low))
        return worst

    def signature(self, word: str, longest: int) -> list[tuple[str, int]]:
        """The (gram, place) that have to be indexed: the (affected + 1) rarest."""
        s = START + word + END
        grams = self.cut(s, longest)
        order = sorted((self.f.get(s[p:e], 0), s[p:e], p) for p, e in grams)
        return [(g, p) for _, g, p in order[:self.affected(s, grams, longest) + 1]]


def longest_gram(length: int, longest: int = LONGEST) -> int:
    """Grams of at most half a bordered word leave one out of every edit's way."""
    return max(SHORTEST, min(longest, (length + 2) // 2))


def letters(word: str) -> int:
    """64 bits, each the parity of some letters: an edit changes at most two."""
    m = 0
    for c in word:
        m ^= 1 << (ord(c) & 63)
    return m - (1 << 64) if m >> 63 else m


# ---------------------------------------------------------------- near words

#: Roles of an index row: with words of its own length, as the longer word, as the shorter word, and asking words of its own length under the salts of a hot key.
SAME, LONGER, SHORTER, ASKING = 0, 1, 2, 3


def _keys(grams: Grams, word: str, longest: int) -> list[tuple[int, int]]:
    """The (role, key) under which a word is indexed."""
    n, known = len(word), {}

    def signature(length: int) -> list[tuple[str, int]]:
        q = longest_gram(length, longest)
        if q not in known:
            known[q] = grams.signature(word, q)
        return known[q]

    key = lambda g, length, p, kind: xxhash.xxh64_intdigest(f"{g}{length},{p},{kind}") - (1 << 63)
    return ([(SAME, key(g, n, p, 0)) for g, p in signature(n)] + [(LONGER, key(g, n, p, 1)) for g, p in signature(n - 1)]
            + [(SHORTER, key(g, n + 1, p + step, 1)) for g, p in signature(n) for step in (0, 1)])


def _hot_keys(words: DataFrame, sent, longest: int, hot: int) -> dict[int, int]:
    """{key: salts} of the keys that more than ``hot`` words hold, by an estimate from a sample of the words."""
    share = min(1.0, SAMPLE_WORDS / max(1, words.count()))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(sent.value)
        for b in batches:
            keys = [k for w in b.column(0).to_pylist() for role, k in _keys(grams, w, longest) if role != SHORTER]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64())], ["key"])

    held = words.select("word").sample(share, seed=3).mapInArrow(rows, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    held = materialize(held.where(F.col("n") > max(1, int(hot * share))), "spelling-hot")
    while True:
        found = held.where(F.col("n") > max(1, int(hot * share))).limit(MAX_HOT + 1).collect()
        if len(found) <= MAX_HOT:
            drop_table(held)
            return {r["key"]: math.ceil(r["n"] / share / hot) for r in found}
        hot *= 2


def _index(words: DataFrame, dictionary: dict[str, int], longest: int, hot: int) -> DataFrame:
    """(key, role, mask, id, word, n).  Keys that many words hold are dealt over salts: a word is found under one of them and asks under all."""
    spark = words.sparkSession.sparkContext
    sent = spark.broadcast(dictionary)
    salts = spark.broadcast(_hot_keys(words, sent, longest, hot))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, many = Grams(sent.value), salts.value
        for b in batches:
            at, role, keys, mask = [], [], [], []
            for r, (i, w) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                own = []
                for kind, k in _keys(grams, w, longest):
                    n = many.get(k, 1)
                    if n == 1:
                        own.append((kind, k))
                        continue
                    salted = [k ^ (s * SALT & (1 << 62) - 1) for s in range(n)]
                    if kind != SHORTER:
                        own.append((kind, salted[i % n]))
                    if kind != LONGER:
                        own += [(ASKING if kind == SAME else SHORTER, x) for x in salted]
                at += [r] * len(own)
                mask += [letters(w)] * len(own)
                role += [x for x, _ in own]
                keys += [x for _, x in own]
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(role, pa.int8()), pa.array(mask, pa.int64()),
                                              *(b.column(i).take(take) for i in range(3))], ["key", "role", "mask", "id", "word", "n"])

    return words.select("id", "word", "n").mapInArrow(rows, "key long, role byte, mask long, id long, word string, n long")


def near_words(words: DataFrame, longest: int = LONGEST, threshold: int = THRESHOLD, max_grams: int = MAX_GRAMS, hot: int = HOT) -> DataFrame:
    """(a, a_word, a_n, b, b_word, b_n): the pairs of ``words`` (id, word, n) that differ by one edit; a pair may come repeatedly."""
    index = materialize(_index(words, gram_dictionary(words, longest, threshold, max_grams), longest, hot), "spelling-index")

    def side(roles: list[int], name: str) -> DataFrame:
        return index.where(F.col("role").isin(roles)).select("key", F.col("mask").alias(f"{name}_mask"), F.col("id").alias(name),
                                                             F.col("word").alias(f"{name}_word"), F.col("n").alias(f"{name}_n"))

    alike = (F.bit_count(F.col("a_mask").bitwiseXOR(F.col("b_mask"))) <= 2) & (F.levenshtein("a_word", "b_word", 1) == 1)
    held = side([SAME], "b")
    same = side([SAME], "a").join(held, "key").where((F.col("a") < F.col("b")) & alike)
    # Under a salted key the words of one salt have met above; those of others meet here, each pair in both directions.
    salted = side([ASKING], "a").join(held, "key").where((F.col("a") < F.col("b")) & alike)
    other = side([SHORTER], "a").join(side([LONGER], "b"), "key").where(alike)
    return same.unionByName(salted).unionByName(other).select("a", "a_word", "a_n", "b", "b_word", "b_n")


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, **index) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    if min_length < SHORTEST:
        raise ValueError(f"words of fewer than {SHORTEST} code points have no gram")
    words = word_counts(docs, min_length, min_count).repartition(partitions(docs))
    words = materialize(words.withColumn("id", F.monotonically_increasing_id()), "spelling-words")
    pairs = near_words(words, **index)
    ways = F.array(*[F.struct(F.col(x).alias("id"), F.col(y).alias("other"),
                              F.when(F.col(f"{y}_n") >= ratio * F.col(f"{x}_n"), F.struct((-F.col(f"{y}_n")).alias("less"), F.col(f"{y}_word").alias("form"))).alias("best"))
                     for x, y in (("a", "b"), ("b", "a"))])
    near = pairs.select(F.inline(ways)).distinct().groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), F.min("best").alias("best"))
    got = words.join(near, "id", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                                F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))
    got = materialize(got, "spelling-forms")
    # A form is at least ``ratio`` times as frequent, so chains are short and doubling the steps ends after a few rounds.
    steps = materialize(got.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        nxt = materialize(steps.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                                    F.col("further").isNotNull().alias("moved")), "spelling-roots")
        moved = nxt.where("moved").limit(1).count()
        drop_table(steps)
        steps = nxt.drop("moved")
        if not moved:
            break
    return got.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of all documents."""
    return variants(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents) GROUP BY ALL),
tbl AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t),
hashed AS (
  SELECT run, k, xor(list_reduce(
           flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
                                  lambda s: CASE WHEN unicode(s) < 128 THEN [unicode(s)] ELSE [192 + (unicode(s) >> 6), 128 + (unicode(s) & 63)] END)),
           lambda c, b: xor(c >> 8, t[(xor(c, CAST(b AS BIGINT)) & 255) + 1]), 4294967295), 4294967295) AS h
  FROM runs, tbl WHERE length(run) >= 7),
spelt AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed),
w AS (SELECT word, sum(k)::BIGINT AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
holes AS (SELECT word, n, i, substr(word, 1, i - 1) AS l, substr(word, i + 1) AS r FROM w, unnest(range(1, length(word) + 1)) u(i)),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM holes a JOIN holes b ON a.i = b.i AND a.l = b.l AND a.r = b.r AND a.word <> b.word
  UNION SELECT w.word, h.word, h.n FROM w JOIN holes h ON w.word = h.l || h.r
  UNION SELECT h.word, w.word, w.n FROM w JOIN holes h ON w.word = h.l || h.r),
best AS (SELECT word, count(*) AS n_near, max(m) AS most FROM near GROUP BY word),
tops AS (SELECT word, other, m, row_number() OVER (PARTITION BY word ORDER BY m DESC, encode(other)) AS place FROM near),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * w.n THEN other END AS form, CASE WHEN m >= 10 * w.n THEN m END AS form_n
          FROM w LEFT JOIN best USING (word) LEFT JOIN tops ON tops.word = w.word AND place = 1),
walk AS (SELECT word, word AS root, form AS onward FROM forms
         UNION ALL SELECT walk.word, forms.word, forms.form FROM walk JOIN forms ON forms.word = walk.onward)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN walk USING (word) WHERE walk.onward IS NULL
"""

QUERIES = {"op11_spelling": op11_spelling}
ORACLES = {"op11_spelling": SQL}
