"""Line dedup: fuzzy copies of lines by MinHash, one line kept per component.

A document's lines are split at line feeds; a line is compared by its lower-cased text with white
space runs as one space, trimmed.  Lines equal in that form are one node, so frequent lines
never meet in a task.  A node's set is its character shingles of ``SHINGLE`` code points (a shorter line
is one shingle); two nodes link if the sets' Jaccard similarity is at least ``SIMILARITY`` (0.8).

Candidates: MinHash in bins, filled for short lines as well as for long ones (``_sketches``), one key per band of ``rows`` bins.  ``banding`` chooses rows and bands by
the number of lines: buckets stay small at any size, and at a similarity of 0.8 a pair shares a band with
probability 0.996 (0.9996 at 0.85).  With a key goes a sketch of one bit from each of 64 bins; in a bucket a line
whose sketch differs from all others in over ``DIFFERING`` bits is no candidate (at 0.8 the sketches differ in 6 bits on
average, in over 18 about once in 100,000 pairs).
Band buckets are cut into blocks (a hot bucket spreads over many tasks), each block and each two blocks of a
bucket are verified in a task on the lines' exact shingle sets; pairs that are already connected are skipped, as are pairs
whose bin counts show that they share too little,
and only a spanning forest of the links leaves the task.  Distributed union-find gives the
components; the line that comes first (doc_id, text hash, line number; null ids last) is kept, all other lines of the
component are removed from their documents.

Nulls and ties: a null or empty text has no lines and stays as it is; blank lines are no lines and
stay; a row with a null doc_id takes part; rows that repeat doc_id and text are one document, all of
them get the same result; an empty table gives no rows; other columns are kept by ``dedup_lines``.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import band_blocks, block_units, components, drop_table, materialize, near_members, packed, table

SHINGLE = 5
SIMILARITY = 0.8
SKETCH_BINS = 64
DIFFERING = 18
#: Hashes that spread a line's shingles over the bins before bins that stay empty get hashes of their own.
ROUNDS = 6
MISSED = 0.0035
#: Bytes of packed lines that are verified together, but for a longer unit.
HELD_BYTES = 1 << 20
BLOCK = 256
#: Bins of a shingle set's counts, which bound what two sets can share.
COUNT_BINS = 256
#: Band keys that are sorted together.
PART_KEYS = 1 << 17
#: Bits of the table of lines whose text is wanted: 16 MB in a task, whatever their number.
TABLE_BITS = 27
_NONE = np.uint32(0xFFFFFFFF)


def normal(line: str) -> str:
    return " ".join(line.lower().split())


#: What a text may hold that leaves its lines other than their normal form.
_ODD = re.compile(r"[^\S\n ]")
_ODD_ASCII = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"


def _odd(text: str) -> bool:
    return any(c in text for c in _ODD_ASCII) if text.isascii() else _ODD.search(text) is not None


def normal_lines(text: str) -> list[str]:
    """``normal`` of every line of a text."""
    text = text.lower()
    if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " " or _odd(text):
        return [" ".join(x.split()) for x in text.split("\n")]
    return text.split("\n")


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _mix32(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(16)
    return h


def _bin(h: np.ndarray, bins: int) -> np.ndarray:
    return (h >> np.uint32(26)).astype(np.int64) if bins == 64 else (_mix32(h.copy()) % np.uint32(bins)).astype(np.int64)


def _rehashed(h: np.ndarray, seed) -> np.ndarray:
    return _mix32(h + np.uint32(0x9E3779B9) * seed)


def _sketches(h: np.ndarray, line: np.ndarray, n: int, bins: int) -> np.ndarray:
    """(n, bins): one MinHash value per bin of the shingle hashes ``h`` of the lines 0..n-1 (``line`` ascends, no line without a shingle).

    The shingles of a line are spread over the bins, those of lines with empty bins again by other hashes (``ROUNDS`` times in all), where
    they fill empty bins only.  A bin that is still empty gets the minimum of its own hash over all shingles of the line.  So two
    lines agree in a bin with the probability of their similarity, and the bins of a short line are as good as independent."""
    out = np.full(n * bins, _NONE)
    np.minimum.at(out, line * bins + _bin(h, bins), h)
    for r in range(1, ROUNDS):
        keep = (out.reshape(n, bins) == _NONE).any(axis=1)[line]
        h, line = h[keep], line[keep]
        if not len(h):
            return out.reshape(n, bins)
        g = _rehashed(h, np.array([r], np.uint32))
        at = line * bins + _bin(g, bins)
        free = out[at] == _NONE
        np.minimum.at(out, at[free], g[free])
    keep = (out.reshape(n, bins) == _NONE).any(axis=1)[line]
    distinct = np.unique(line[keep].astype(np.uint64) << np.uint64(32) | h[keep])
    h, line = distinct.astype(np.uint32), (distinct >> np.uint64(32)).astype(np.int64)
    count = np.bincount(line, minlength=n)
    first = np.cumsum(count) - count
    empty = np.flatnonzero(out == _NONE)
    own, ends = empty // bins, np.cumsum(count[empty // bins])
    lo = 0
    while lo < len(empty):  # runs of about a million hashes, or one longer line
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + (1 << 20), side="right")))
        size = count[own[lo:hi]]
        start = np.cumsum(size) - size
        each = np.arange(size.sum()) + np.repeat(first[own[lo:hi]] - start, size)
        seed = (ROUNDS + empty[lo:hi] % bins).astype(np.uint32)
        out[empty[lo:hi]] = np.minimum.reduceat(_rehashed(h[each], np.repeat(seed, size)), start)
        lo = hi
    return out.reshape(n, bins)


def banding(lines: int, similarity: float = SIMILARITY) -> tuple[int, int]:
    """(bands, rows): one more row for each five-fold growth past 2.5 million lines, and as many bands as
    keep the share of missed pairs at ``similarity`` under ``MISSED``."""
    rows = max(4, 4 + math.ceil(math.log(max(1, lines) / 2.6e6) / math.log(5)))
    return math.ceil(math.log(MISSED) / math.log(1 - similarity ** rows)), rows


def band_keys(lines: list[str], bands: int, rows: int) -> np.ndarray:
    """(lines, bands + 1) of non-empty normalized lines, as int64: the band keys, then the sketch."""
    bins = max(SKETCH_BINS, bands * rows)
    padded = [x if len(x) >= SHINGLE else x.ljust(SHINGLE) for x in lines]
    lengths = np.fromiter(map(len, padded), np.int64, len(padded))
    out = np.empty((len(lines), bands + 1), np.uint64)
    lo = 0
    while lo < len(lines):  # runs that stay in the cache, or one longer line
        hi = max(lo + 1, int(np.searchsorted(np.cumsum(lengths[lo:]), 1 << 18, side="right")) + lo)
        n = hi - lo
        codes = np.frombuffer("".join(padded[lo:hi]).encode("utf-32-le", "surrogatepass"), np.uint32)
        own = lengths[lo:hi]
        h = np.zeros(len(codes) - SHINGLE + 1, np.uint32)
        for i in range(SHINGLE):
            h = h * np.uint32(0x01000193) + codes[i:i + len(h)]
        inside = np.ones(len(h), bool)
        for i in range(1, SHINGLE):  # shingles that run over the end of a line
            inside[np.cumsum(own)[:-1] - i] = False
        line = np.repeat(np.arange(n), own - SHINGLE + 1)
        h = _mix32(h[inside])
        sketch = _sketches(h, line, n, bins).astype(np.uint64)
        key = np.full((n, bands), np.uint64(1))
        for i in range(rows):
            key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + sketch[:, i * bands:(i + 1) * bands])
        out[lo:hi, :bands] = _mix(key + np.arange(bands, dtype=np.uint64))
        bits = (_mix(sketch[:, :SKETCH_BINS] + np.arange(SKETCH_BINS, dtype=np.uint64)) >> np.uint64(63)) << np.arange(SKETCH_BINS, dtype=np.uint64)
        out[lo:hi, bands] = np.bitwise_or.reduce(bits, axis=1)
        lo = hi
    return out.view(np.int64)


def similar(a, b, least: float = SIMILARITY) -> bool:
    """Whether the Jaccard similarity of two shingle sets (``shingles``) is at least ``least``, exactly."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    if isinstance(a, np.ndarray) and isinstance(b, np.ndarray):
        merged = np.sort(np.concatenate([a, b]))
        both = int(np.count_nonzero(merged[1:] == merged[:-1]))
    else:
        both = len(_as_set(a) & _as_set(b))
    return both >= least * (len(a) + len(b) - both)


def shingles(line: str):
    """The distinct shingles of a line: five code points of twelve bits packed into a sorted array of numbers, or a
    set of strings for a line with code points from 4096 on."""
    padded = line.ljust(SHINGLE, "\0") if len(line) < SHINGLE else line
    codes = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), np.uint32)
    if codes.max() >= 4096:
        return {padded[i:i + SHINGLE] for i in range(len(padded) - SHINGLE + 1)}
    return np.unique(_packed_codes([codes[i:len(codes) - SHINGLE + 1 + i] for i in range(SHINGLE)]))


def _as_set(x) -> set:
    if isinstance(x, set):
        return x
    return {"".join(chr(int(v) >> shift & 4095) for shift in (48, 36, 24, 12, 0)) for v in x}


def _row_columns(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def line_count(docs: DataFrame) -> int:
    """The number of lines: of line feeds and one for each text."""
    feeds = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    return docs.agg(F.sum(feeds.cast("long") + 1)).first()[0] or 0


def _binaries(rows: np.ndarray) -> pa.Array:
    """One binary value for each row of a matrix."""
    data = np.ascontiguousarray(rows)
    width = data.itemsize * (data.shape[1] if data.ndim > 1 else 1)
    ends = np.arange(len(data) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _lines(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per non-blank line: its document, number and digest.  Of equal lines of a run that which comes first has their
        number and, packed, their band keys and sketch; the others have 0 and null."""
        for b in batches:
            ids, hashes = b.column(0).to_pylist(), b.column(1).to_pylist()
            row, pos, number, size = [], [], [], 0
            lines: dict[str, int] = {}  # to their numbers
            first: list[int] = []  # places in ``row`` and ``pos`` by number

            def place(at: int) -> tuple:
                i = row[at]
                return ids[i] is None, ids[i] or 0, hashes[i], pos[at]

            def out():
                own, which = pa.array(row, pa.int64()), np.array(number, np.int64)
                digests = pa.array([hashlib.md5(x.encode("utf-8", "surrogatepass")).digest() for x in lines], pa.binary())
                carrier = np.full(len(row), -1)
                carrier[first] = np.arange(len(first))
                carries = carrier >= 0
                n = np.zeros(len(row), np.int64)
                n[first] = np.bincount(which)
                return pa.RecordBatch.from_arrays(
                    [b.column(0).take(own), b.column(1).take(own), pa.array(pos, pa.int32()), digests.take(pa.array(which)), pa.array(n),
                     _binaries(band_keys(list(lines), bands, rows)).take(pa.array(carrier, mask=~carries))], ["doc_id", "text_hash", "pos", "line", "n", "keys"])

            for i, t in enumerate(b.column(2)):
                t = t.as_py()
                for n, x in enumerate(normal_lines(t) if t else ()):
                    if x:
                        at = len(row)
                        row.append(i)
                        pos.append(n)
                        known = lines.setdefault(x, len(first))
                        number.append(known)
                        if known == len(first):
                            first.append(at)
                            size += len(x)
                        elif place(at) < place(first[known]):
                            first[known] = at
                if size > 4 << 20 or len(row) > 1 << 17:
                    yield out()
                    row, pos, number, size, lines, first = [], [], [], 0, {}, []
            if row:
                yield out()
    return run


def _packed_codes(codes: list[np.ndarray]) -> np.ndarray:
    """Numbers of shingles from their code points (twelve bits each): one to one below 4096, elsewhere a function of the shingle still."""
    out = codes[0].astype(np.uint64)
    for c in codes[1:]:
        out = out << np.uint64(12) | c
    return out


def _sets(lines: list[str]) -> tuple[list, np.ndarray, np.ndarray]:
    """The sets of ``shingles`` for many lines, their sizes, and how many members of each fall into each bin (a function of the shingle)."""
    padded = [x if len(x) >= SHINGLE else x.ljust(SHINGLE, "\0") for x in lines]
    length = np.fromiter(map(len, padded), np.int64, len(padded))
    first = np.cumsum(length) - length
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    high = np.maximum.reduceat(codes, first) >= 4096
    number = _packed_codes([codes[i:len(codes) - SHINGLE + 1 + i] for i in range(SHINGLE)])
    keep = np.ones(len(number), bool)
    for i in range(1, SHINGLE):  # shingles that run over the end of a line
        keep[first[1:] - i] = False
    for lo, n in zip(first.tolist(), length.tolist()):
        number[lo:lo + n - SHINGLE + 1].sort()
    new = np.r_[True, number[1:] != number[:-1]]
    new[first] = True
    keep &= new & ~np.repeat(high, length)[:len(keep)]
    size = np.add.reduceat(keep, first, dtype=np.int64)
    number = number[keep]
    ends = np.cumsum(size)
    sets: list = [number[z - n:z] for z, n in zip(ends.tolist(), size.tolist())]
    bins = (_mix(number) >> np.uint64(40)).astype(np.int64) % COUNT_BINS
    counts = np.bincount(np.repeat(np.arange(len(sets)) * COUNT_BINS, size) + bins, minlength=len(sets) * COUNT_BINS).reshape(-1, COUNT_BINS)
    for i in np.flatnonzero(high).tolist():
        sets[i] = shingles(lines[i])
        size[i] = len(sets[i])
        own = np.frombuffer("".join(sets[i]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, SHINGLE)
        bins = (_mix(_packed_codes(list(own.T))) >> np.uint64(40)).astype(np.int64) % COUNT_BINS
        counts[i] = np.bincount(bins, minlength=COUNT_BINS)
    return sets, size, counts.astype(np.uint16 if size.max() < 1 << 16 else np.int64)


def _verify(least: float):
    """Links that connect the members of a unit, of rows (unit, side, id, sketch, text) whose units are not torn: exact similarity of the
    pairs whose sketches are near.

    Two sets share at most the smaller count of each bin (``_sets``), so a pair whose bins cannot hold enough shared
    shingles is not similar, whatever the shingles are; all other pairs are compared shingle by shingle."""
    def links(rows: pa.Table) -> list[pa.Array]:
        unit, side, ids, sketch = (rows.column(i).to_numpy() for i in range(4))
        order = np.lexsort((ids, side, unit))
        unit, side, ids, sketch = unit[order], side[order], ids[order], sketch[order].view(np.uint64)
        distinct, place, at = np.unique(ids, return_index=True, return_inverse=True)
        texts = rows.column(4).take(pa.array(order[place])).to_pylist()
        sets, sizes, counts = _sets([zlib.decompress(t).decode("utf-8", "surrogatepass") for t in texts])

        start = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
        size = np.diff(np.r_[start, len(unit)])
        begins, ends = np.repeat(start, size), np.repeat(start + size, size)
        pairs = start[size == 2]
        firsts, seconds = [pairs], [pairs + 1]
        for lo, n in zip(start[size > 2].tolist(), size[size > 2].tolist()):
            x, y = sketch[lo:lo + n], side[lo:lo + n]
            cut = int((y == 0).sum())
            near = np.bitwise_count(x[:cut, None] ^ x[None, :]) <= DIFFERING
            i, j = np.nonzero(np.triu(near, 1) if cut == n else near & (y == 1))
            firsts.append(i + lo)
            seconds.append(j + lo)
        i, j = np.concatenate(firsts), np.concatenate(seconds)
        known, judged, found = np.arange(len(ids)), {}, []  # the class of each row; rows of different units are never joined
        for lo in range(0, len(i), 1024):
            i_, j_ = i[lo:lo + 1024], j[lo:lo + 1024]
            x, y = at[i_], at[j_]
            may = np.flatnonzero((known[i_] != known[j_]) & (np.minimum(sizes[x], sizes[y]) >= least * np.maximum(sizes[x], sizes[y])) & (x != y))
            both, total = np.minimum(counts[x[may]], counts[y[may]]).sum(axis=1, dtype=np.int64), (sizes[x] + sizes[y])[may]
            may = may[both >= least * (total - both)]
            for k, n, *pair in zip(i_[may].tolist(), j_[may].tolist(), x[may].tolist(), y[may].tolist()):
                if known[k] == known[n]:
                    continue
                pair = tuple(pair)
                if pair not in judged:
                    judged[pair] = similar(sets[pair[0]], sets[pair[1]], least)
                if judged[pair]:
                    own = known[begins[k]:ends[k]]
                    own[own == known[n]] = known[k]
                    found.append(pair)
        found = np.array(found, np.int64).reshape(-1, 2)
        return [pa.array(distinct[found[:, i]], pa.int64()) for i in (0, 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            held = pa.concat_tables([held, pa.Table.from_batches([b])]).combine_chunks() if held else pa.Table.from_batches([b])
            if held.nbytes > HELD_BYTES:  # the units that are looked at together stay bounded; the last may go on
                unit = held.column(0).to_numpy()
                cut = int(np.searchsorted(unit, unit[-1])) if len(unit) else 0
                if cut:
                    yield pa.RecordBatch.from_arrays(links(held.slice(0, cut)), ["a", "b"])
                    held = held.slice(cut)
        if held:
            yield pa.RecordBatch.from_arrays(links(held), ["a", "b"])
    return run


def _slots(row: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Slots of lines (``pos`` -1: of their documents) in the bit table."""
    h = row.view(np.uint64) + (pos.astype(np.int64) + 1).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(29))) & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)


def _texts(three: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, text as zlib bytes) of the wanted lines (id, doc_id, text_hash, pos), read from the documents again.  A bit
    table of fixed size holds back most others; the join that follows is exact."""
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = np.zeros((1 << TABLE_BITS) // 8, np.uint8)
        for b in batches:
            r, p = b.column(0).to_numpy(), b.column(1).to_numpy()
            for s in (_slots(r, np.full(len(r), -1)), _slots(r, p)):
                np.bitwise_or.at(got, s >> 3, np.uint8(1) << (s & 7).astype(np.uint8))
        used = np.flatnonzero(got)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array([used.astype(np.int32).tobytes()], pa.binary()),
                                              pa.array([got[used].tobytes()], pa.binary())], ["at", "byte"])

    row = F.xxhash64("doc_id", "text_hash")
    marks = np.zeros((1 << TABLE_BITS) // 8, np.uint8)
    for part in wanted.select(row.alias("row"), "pos").mapInArrow(fill, "at binary, byte binary").toLocalIterator():
        marks[np.frombuffer(part["at"], np.int32)] |= np.frombuffer(part["byte"], np.uint8)
    sent = three.sparkSession.sparkContext.broadcast(marks.tobytes())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(sent.value, np.uint8)

        def marked(r: np.ndarray, p: np.ndarray) -> np.ndarray:
            s = _slots(r, p)
            return np.flatnonzero(known[s >> 3] >> (s & 7).astype(np.uint8) & 1)

        for b in batches:
            rows = b.column(3).to_numpy()
            own = marked(rows, np.full(len(rows), -1))
            lines = [(t.split("\n") if (t := b.column(2)[i].as_py()) else []) for i in own.tolist()]
            count = np.fromiter(map(len, lines), np.int64, len(lines))
            doc = np.repeat(np.arange(len(lines)), count)
            place = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            at, pos, found = [], [], []
            for i in marked(rows[own][doc], place).tolist():
                if x := normal(lines[doc[i]][place[i]]):
                    at.append(own[doc[i]])
                    pos.append(place[i])
                    found.append(zlib.compress(x.encode("utf-8", "surrogatepass"), 1))
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(pos, pa.int32()), pa.array(found, pa.binary())],
                                             ["_id", "_hash", "_pos", "text"])

    seen = three.select("doc_id", "text_hash", "text", row.alias("row")).mapInArrow(scan, "_id long, _hash long, _pos int, text binary")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")) & (F.col("pos") == F.col("_pos"))
    return wanted.join(seen, same).select("id", "text").dropDuplicates(["id"])


def _slim(df: DataFrame, name: str, *columns) -> DataFrame:
    """The columns that later steps need, written anew; the wide table's files go."""
    out = materialize(df.select(*columns), name)
    drop_table(df)
    return out


def removed_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_hash, removed array<int>): the line numbers that go, for documents that lose any."""
    three = _row_columns(docs)
    count = line_count(docs)
    bands, rows = banding(count, similarity)
    lines = materialize(three.mapInArrow(_lines(bands, rows), "doc_id long, text_hash long, pos int, line binary, n long, keys binary"), "lines")
    place = F.struct(F.col("doc_id").isNull().alias("anon"), "doc_id", "text_hash", "pos", "keys")
    # equal lines of a run are one row already: dealt out first, the rows are sorted once and not before their exchange as well
    full = materialize(lines.where("n > 0").select("line", "n", place.alias("place")).repartition("line")
                       .groupBy("line").agg(F.min("place").alias("first"), F.sum("n").alias("n"))
                       .select(F.monotonically_increasing_id().alias("id"), "line", "n", "first.*"), "line-nodes")
    lines = _slim(lines, "lines-slim", "doc_id", "text_hash", "pos", "line")
    blocks = materialize(band_blocks(full.select("id", "keys"), bands, max(1, count * bands // PART_KEYS), BLOCK, DIFFERING), "line-blocks")
    nodes = full.select("id", "line", "n", F.struct("anon", "doc_id", "text_hash", "pos").alias("spot"))
    units = block_units(blocks).dropDuplicates(["a", "b"]).withColumn("unit", F.monotonically_increasing_id())
    members = materialize(near_members(materialize(units, "line-units"), DIFFERING), "line-members")
    wanted = materialize(members.select("id").distinct().join(nodes.select("id", "spot"), "id").select("id", "spot.*").drop("anon"), "line-wanted")
    sets = members.join(_texts(three, wanted), "id").select("unit", "side", "id", "sketch", "text").repartition("unit").sortWithinPartitions("unit")
    cc = components(sets.mapInArrow(_verify(similarity), "a long, b long"), "line-cc")

    fuzzy = materialize(nodes.join(cc, F.col("id") == F.col("node")).select("line", "spot", "root"), "line-fuzzy")
    kept = fuzzy.groupBy("root").agg(F.min("spot").alias("kept"))
    again = (fuzzy.join(kept, "root").select("line", "kept")
             .unionByName(nodes.where("n > 1").join(fuzzy, "line", "left_anti").select("line", F.col("spot").alias("kept"))))
    gone = (lines.select("doc_id", "text_hash", "pos", "line").join(again, "line")
            .where(~(F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("text_hash") == F.col("kept.text_hash"))
                     & (F.col("pos") == F.col("kept.pos")))))
    return gone.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("removed"))


@F.pandas_udf(T.StringType())
def _without(text: pd.Series, removed: pd.Series) -> pd.Series:
    def cut(t, r):
        if t is None or r is None:
            return None
        gone = set(r.tolist())
        return "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
    return pd.Series([cut(t, r) for t, r in zip(text, removed)], dtype=object)


def _marked(docs: DataFrame, similarity: float) -> DataFrame:
    """(row struct, text, removed): the text without the removed lines; the row is packed, so that no column name clashes."""
    gone = removed_lines(docs, similarity).select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "removed")
    rows = packed(docs)
    # the lists of line numbers are the hashed side, so that the rows with their texts are not sorted
    j = rows.join(gone.hint("shuffle_hash"), F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("row.text") == F.col("hash")), "left")
    touched = F.col("removed").isNotNull()
    cut = _without(F.when(touched, F.col("row.text")), F.col("removed"))
    return j.select("row", F.when(touched, cut).otherwise(F.col("row.text")).alias("text"), "removed")


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` (doc_id, text, any others) with the repeated lines taken out of the texts; n_chars, if there, follows.
    A document all of whose lines are copies stays, with an empty text."""
    out = _marked(docs, similarity)

    def column(c: str) -> Column:
        if c == "text":
            return F.col("text")
        if c == "n_chars":
            return F.when(F.col("removed").isNotNull(), F.length("text")).otherwise(F.col("row.n_chars")).cast(docs.schema[c].dataType).alias(c)
        return F.col("row").getField(c).alias(c)

    return out.select(*[column(c) for c in docs.columns])


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_removed, removed (line numbers) and text without them, of every document."""
    out = _marked(table(spark, sf_dir, "documents").select("doc_id", "text"), SIMILARITY)
    return out.select("row.doc_id", F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"),
                      F.coalesce("removed", F.array().cast("array<int>")).alias("removed"), "text")


QUERIES = {"op3_lines": op3_lines}
ORACLES: dict[str, str] = {}
