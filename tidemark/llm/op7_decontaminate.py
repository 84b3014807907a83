"""Benchmark decontamination by size-partitioned MinHash containment search.

Which short test items are contained in which long documents: an item is contained if at least
``containment`` (0.8) of its distinct five-word shingles occur in the document.  Words are runs
of word characters of the lower-cased text; an item of fewer than five words has its whole word sequence as its one shingle,
and is contained in the documents in which these words stand in a row.  One word alone is no passage: an item of fewer than
``min_words`` (2; 1 looks for single words too) is contained only in documents that are these words and nothing else.

A MinHash of a long document says nothing about a short item, so the search is partitioned by size.
Items fall into classes by their number of shingles (class u holds sizes in (u/2, u], u a power of two).
For each class that occurs, a document is read as windows of 2u shingles that start every u shingles, so
that any passage as long as an item of the class lies whole in one window and is at least a quarter
of it.  Items and windows get one-permutation MinHash sketches of ``BINS`` bins; the sketch of a larger class is
the bin-wise minimum of two smaller ones.  A window and an item of its class that share any sketch value are a
candidate pair, which is then verified exactly on the words of the item and the whole document.
The items of each word count under five are a class of their own, for which the documents' shingles of that many words are looked up.
At a containment of 0.8 a passage shares no value in about 1 of 1,000 cases in the worst size, 1 of 5,000 if verbatim.

A fixed-size bit table of the items' sketch values goes to every task; only documents in which one occurs
are sketched and leave the scan, whatever the number of items.  The exact match of values is a join.

Nulls and ties: null and empty texts have no shingle, contain nothing and are contained in nothing; rows
with a null id take part (their pairs have a null id); repeated rows give one pair; two items with the same
text are two items; empty tables give no pairs; other columns are ignored.  Texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, packed, table

SHINGLE = 5
CONTAINMENT = 0.8
MIN_WORDS = 2
BINS = 128
#: Slots of the bit table: 16 MB at most in a task, whatever the number of items.
TABLE_BITS = 24
#: An item of k < SHINGLE words is of class SHORT + k; other classes are sizes.
SHORT = 1 << 40
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class WordHash(dict):
    """XXH64 of words, remembered for up to a million of them."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h

    def __call__(self, ws: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, ws), np.uint64, len(ws))


def shingle_hashes(h: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """One 64-bit hash per run of ``k`` words (one for a shorter sequence, none for an empty one)."""
    k = min(k, len(h))
    if not k:
        return h
    n = len(h) - k + 1
    out = np.full(n, np.uint64(k))
    for i in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n]
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def size_class(n: int) -> int:
    """The smallest power of two that is at least ``n``."""
    return 1 << max(0, n - 1).bit_length()


def sketches(shingles: np.ndarray, unit: int) -> np.ndarray:
    """Bin-wise minima of every run of ``unit`` shingles: (runs, BINS), NONE in empty bins."""
    runs = -(-len(shingles) // unit)
    out = np.full(runs * BINS, NONE)
    at = np.arange(len(shingles)) // unit * BINS + (shingles % np.uint64(BINS)).astype(np.int64)
    np.minimum.at(out, at, shingles)
    return out.reshape(runs, BINS)


def class_key(values: np.ndarray, unit: int) -> np.ndarray:
    """Sketch value and class in one number (a bin is part of its values)."""
    return (values ^ np.uint64(unit)) * np.uint64(0x94D049BB133111EB)


def item_keys(text: str | None) -> tuple[int, np.ndarray]:
    """(class, keys) of an item."""
    ws = words(text)
    s = shingle_hashes(WordHash()(ws))
    if not len(s):
        return 0, s
    unit = size_class(len(np.unique(s))) if len(ws) >= SHINGLE else SHORT + len(ws)
    sketch = sketches(s, max(len(s), 1))[0]
    return unit, class_key(sketch[sketch != NONE], unit)


def window_keys(shingles: np.ndarray, classes: list[int]) -> np.ndarray:
    """Distinct keys of the windows of every class (ascending powers of two)."""
    found = []
    unit, runs = classes[0], sketches(shingles, classes[0])
    for c in classes:
        while unit < c:
            if len(runs) % 2:
                runs = np.vstack([runs, np.full((1, BINS), NONE)])
            runs, unit = np.minimum(runs[0::2], runs[1::2]), unit * 2
        windows = np.minimum(runs[:-1], runs[1:]) if len(runs) > 1 else runs
        found.append(class_key(np.unique(windows[windows != NONE]), c))
    return np.unique(np.concatenate(found))


def looked_for(k: int, words_: int, min_words: int) -> bool:
    """Whether an item of ``k`` words is looked for in a document of ``words_`` words."""
    return words_ >= k if k >= min_words else words_ == k


def row_key(id_col: str, text_col: str) -> Column:
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("~")), F.hex(F.xxhash64(text_col)))


def containment_pairs(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT, min_words: int = MIN_WORDS) -> DataFrame:
    """(row_key, doc_id, item_id, shared, item_shingles, containment) of every verified pair.

    ``docs`` has doc_id and text, ``items`` has item_id and text."""
    spark = docs.sparkSession

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, nos, units, keys, values = [], [], [], [], []
            for i, no, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                unit, k = item_keys(t)
                ids += [i] * len(k)
                nos += [no] * len(k)
                units += [unit] * len(k)
                keys.append(k)
            k = np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(nos, pa.int64()), pa.array(units, pa.int64()), pa.array(k)],
                                             ["item_id", "item_no", "unit", "key"])

    items = materialize(items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
                        .withColumn("item_no", F.monotonically_increasing_id()), "decon-items")
    keys = materialize(items.select("item_id", "item_no", "text").mapInArrow(keyed, "item_id long, item_no long, unit long, key long"), "decon-keys")
    # Sizes are powers of two, so there are a few dozen classes at most.
    units = sorted(r["unit"] for r in keys.select("unit").distinct().collect())
    classes, short = [u for u in units if u < SHORT], [u - SHORT for u in units if u > SHORT]
    pair_schema = "row_key string, doc_id long, item_id long, shared long, item_shingles long, containment double"
    if not units:
        return spark.createDataFrame([], pair_schema)
    bits = 1 << TABLE_BITS
    slots = np.zeros(bits, bool)
    # The table holds shingle hashes (a key with its class taken out again); it has a fixed size.
    for part in keys.select("unit", "key").mapInArrow(_slots(bits), "slots binary").toLocalIterator():
        slots |= np.unpackbits(np.frombuffer(part["slots"], np.uint8)).view(bool)
    sent = spark.sparkContext.broadcast(np.packbits(slots).tobytes())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hashed = np.unpackbits(np.frombuffer(sent.value, np.uint8)).view(bool), WordHash()
        for b in batches:
            hit, found = [], []
            for n, t in enumerate(b.column(2)):
                t = t.as_py()
                if not t:
                    continue
                h = hashed(words(t))
                got = []
                if classes and len(h) >= SHINGLE:
                    s = shingle_hashes(h)
                    if _marked(known, s).any():
                        got.append(window_keys(s, classes))
                for k in short:
                    if looked_for(k, len(h), min_words):
                        s = np.unique(shingle_hashes(h, k))
                        got.append(class_key(s[_marked(known, s)], SHORT + k))
                got = np.concatenate(got) if got else ()
                if len(got):
                    hit.append(n)
                    found.append(got.view(np.int64))
            if hit:
                rows = b.take(pa.array(hit))
                lengths = np.r_[0, np.cumsum([len(f) for f in found])]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(np.concatenate(found)))],
                                                 ["row_key", "doc_id", "text", "keys"])

    three = docs.select(row_key("doc_id", "text").alias("row_key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    hits = three.mapInArrow(scan, "row_key string, doc_id long, text string, keys array<long>")
    # Only values that an item has leave this step; a document with many windows has many others.
    hits = materialize(hits, "decon-hits")
    pairs = (hits.select("row_key", F.explode("keys").alias("key")).join(keys.select("item_id", "item_no", "key"), "key")
             .select("row_key", "item_no").distinct())
    listed = (pairs.join(items, "item_no").groupBy("row_key")
              .agg(F.collect_list(F.struct("item_id", F.col("text").alias("item_text"))).alias("items")))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                ws, cache = words(r["text"]), {}
                for it in r["items"]:
                    iw = words(it["item_text"])
                    k = min(SHINGLE, len(iw))
                    want = {tuple(iw[i:i + k]) for i in range(len(iw) - k + 1)}
                    if k not in cache:
                        cache[k] = set(zip(*[ws[i:] for i in range(k)])) if looked_for(k, len(ws), min_words) else set()
                    shared = len(want & cache[k])
                    if want and shared >= containment * len(want):
                        out.append((r["row_key"], r["doc_id"], it["item_id"], shared, len(want), shared / len(want)))
            if out:
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                                 ["row_key", "doc_id", "item_id", "shared", "item_shingles", "containment"])

    texts = hits.select("row_key", "doc_id", "text").dropDuplicates(["row_key"])
    return texts.join(listed, "row_key").mapInArrow(verify, pair_schema)


def _places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two slots of the bit table per shingle hash."""
    return h >> np.uint64(64 - TABLE_BITS), (h >> np.uint64(64 - 2 * TABLE_BITS)) & np.uint64((1 << TABLE_BITS) - 1)


def _marked(known: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of the shingle hashes may be an item's."""
    first, second = _places(h)
    hit = known[first]
    hit[hit] = known[second[hit]]
    return hit


def _slots(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.zeros(bits, bool)
        back = np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
        for b in batches:
            h = b.column(1).to_numpy().view(np.uint64) * back ^ b.column(0).to_numpy().astype(np.uint64)
            for place in _places(h):
                slots[place] = True
        if slots.any():
            yield pa.RecordBatch.from_arrays([pa.array([np.packbits(slots).tobytes()], pa.binary())], ["slots"])
    return run


def decontaminate(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the documents that contain an item; clean documents stay as they are."""
    bad = containment_pairs(docs, items, containment, min_words).select("row_key").distinct()
    return packed(docs, row_key=row_key("doc_id", "text")).join(bad, "row_key", "left_anti").select("row.*")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, shared, item_shingles, containment) of every test item inside a document."""
    return containment_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_key")


SQL = r"""
WITH i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}\p{M}_]+') AS w FROM benchmark),
n AS (SELECT DISTINCT least(len(w), 5) AS n FROM i WHERE len(w) > 0),
isn AS (SELECT DISTINCT item_id, w[k:k + least(len(w), 5) - 1] AS s FROM i, unnest(range(1, len(w) - least(len(w), 5) + 2)) u(k) WHERE len(w) > 0),
sizes AS (SELECT item_id, count(*) AS item_shingles FROM isn GROUP BY item_id),
d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}\p{M}_]+') AS w FROM documents),
ds AS (SELECT DISTINCT doc_id, w[k:k + n - 1] AS s FROM d, n, unnest(range(1, len(w) - n + 2)) u(k) WHERE n > 1 OR len(w) = 1),
hit AS (SELECT doc_id, item_id, count(*) AS shared FROM isn JOIN ds USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, shared, item_shingles, shared / item_shingles AS containment
FROM hit JOIN sizes USING (item_id) WHERE shared >= 0.8 * item_shingles
"""

QUERIES = {"op7_decontaminate": op7_decontaminate}
ORACLES = {"op7_decontaminate": SQL}
