"""Phrase collocations from counts kept in weighted acyclic automata.

Texts are cut into pieces at punctuation and line ends, pieces into words.  Sequences of one to four words are counted per
language, phrases that occur often are scored by how well their parts predict each other, and each language's best are returned.

A ``Transducer`` is a minimal acyclic automaton over word sequences (the language is the first symbol) whose states carry a
count: how many sequences end there.  The sum below a state is how often its prefix occurs.

1. Each task reads its documents in chunks of ``CHUNK`` words.  A chunk's word windows are sorted, counted and built into a
   transducer, state by state from the sorted sequences, equal states shared.
2. A transducer is cut at prefix borders that all tasks know, and each prefix range is united in one task: sequences merge
   and their counts add up.  Borders come from a sample of the documents; they spread the work and do not change results.
3. The first pass counts words and pairs.  A longer phrase can only be frequent if all its pairs are, so the second pass takes windows of
   three and four words whose pairs are all frequent by a bit table of fixed size; what the table lets through by chance is counted and falls out again.
4. The frequent sequences are built into transducers by prefix range once more, read forward and backward.  Composing a
   candidate with the forward one gives the counts of all its beginnings along one path, with the backward one those of all its ends.

Nulls and ties: a null text is empty, a null language is ``und``; only A-Z are lower-cased; rows that repeat each count; ids play no
part; ties of the score go to the more frequent phrase, then to the smaller one in UTF-8 byte order; empty tables give no rows;
other columns are ignored.  Texts are read whole.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, partitions, table

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
#: A candidate goes if a longer one that holds it has at least this share (in percent) of its count.
INSIDE_PERCENT = 80
CHUNK = 2_000_000
#: Bits of the table of frequent pairs: 8 MB in a task, whatever their number.
TABLE_BITS = 26
#: Documents read for the range borders, and the most borders' candidates that reach the driver.
SAMPLE_DOCS = 2_000
SAMPLE_KEYS = 100_000
_BREAK = b"\xff"  # no byte of UTF-8
_MARKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", _BREAK * 10 + b" ")


def tokens(text: str | None) -> list[bytes]:
    """The words of a text in order, with breaks between its pieces.  No white space but the blank is left to split at."""
    return (text or "").encode("utf-8", "ignore").lower().translate(_MARKS).replace(_BREAK, b" \xff ").split()


# ---------------------------------------------------------------- automata

def sorted_counts(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of a matrix of ranks (-1: no symbol) in order, and the sums of their counts."""
    if not len(rows):
        return rows, counts
    bits = int(rows.max() + 2).bit_length()
    per = max(1, 63 // bits)
    packed = []
    for c in range(0, rows.shape[1], per):
        key = np.zeros(len(rows), np.int64)
        for col in rows[:, c:c + per].T:
            key = (key << np.int64(bits)) + col + 1
        packed.append(key)
    order = np.argsort(packed[0], kind="stable") if len(packed) == 1 else np.lexsort(packed[::-1])
    new = np.zeros(len(rows), bool)
    new[0] = True
    for key in packed:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    first = np.flatnonzero(new)
    return rows[order[first]], np.add.reduceat(counts[order], first)


class Transducer:
    """Minimal weighted acyclic automaton of sequences over ``symbols`` (in byte order), by depth.

    ``final[d]``: the counts of the states at depth d; ``degree[d]``: their arcs, which lie one after another in ``label[d]`` and
    ``target[d]`` (a state of depth d + 1), ordered by label."""

    def __init__(self, symbols, final, degree, label, target):
        self.symbols, self.final, self.degree, self.label, self.target = symbols, final, degree, label, target

    @classmethod
    def build(cls, symbols: pa.BinaryArray, rows: np.ndarray, counts: np.ndarray) -> Transducer:
        """From distinct sorted sequences of ranks, -1 after their end."""
        depth = rows.shape[1]
        node, begins = [np.zeros(len(rows), np.int64)], [np.zeros(min(1, len(rows)), np.int64)]
        new = np.zeros(len(rows), bool)
        for d in range(depth):  # the distinct prefixes of d + 1 symbols
            new = new.copy()
            new[:1] = True
            new[1:] |= rows[1:, d] != rows[:-1, d]
            here = new & (rows[:, d] >= 0)
            node.append(np.cumsum(here) - 1)
            begins.append(np.flatnonzero(here))
        ends = (rows >= 0).sum(axis=1)
        final, degree, label, target = [], [], [], []
        below = None
        for d in range(depth, -1, -1):
            at = begins[d]
            own = np.where(ends[at] == d, counts[at], 0)
            if d == depth:
                lab, tgt, deg = np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(at), np.int64)
            else:
                lab, tgt = rows[begins[d + 1], d].astype(np.int64), below
                deg = np.bincount(node[d][begins[d + 1]], minlength=len(at))
            keep, below = _equal_states(own, deg, lab, tgt)
            arcs = _arcs(deg, keep)
            final.insert(0, own[keep])
            degree.insert(0, deg[keep])
            label.insert(0, lab[arcs])
            target.insert(0, tgt[arcs])
        return cls(symbols, final, degree, label[:-1], target[:-1])

    def sequences(self) -> tuple[np.ndarray, np.ndarray]:
        """All sequences with a count, as ranks, and their counts."""
        depth = len(self.label)
        out, counts = [], []
        paths, state = np.full((len(self.final[0]), depth), -1, np.int64), np.arange(len(self.final[0]))
        for d in range(depth + 1):
            has = self.final[d][state] > 0
            out.append(paths[has])
            counts.append(self.final[d][state][has])
            if d < depth:
                arcs, many = _arcs(self.degree[d], state), self.degree[d][state]
                paths = np.repeat(paths, many, axis=0)
                paths[:, d] = self.label[d][arcs]
                state = self.target[d][arcs]
        return np.concatenate(out), np.concatenate(counts)

    @staticmethod
    def union(parts: Sequence[Transducer]) -> Transducer:
        """The automaton of all sequences of ``parts``, counts summed."""
        symbols, codes = _ranked(pa.concat_arrays([t.symbols for t in parts]))
        rows, counts, at = [], [], 0
        for t in parts:
            r, c = t.sequences()
            rows.append(np.r_[codes[at:at + len(t.symbols)], -1][r])
            counts.append(c)
            at += len(t.symbols)
        return Transducer.build(symbols, *sorted_counts(np.concatenate(rows), np.concatenate(counts)))

    def prefixes(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, sequences, count of everything that begins so) for every length."""
        below = [f.copy() for f in self.final]
        for d in range(len(self.label) - 1, -1, -1):
            from_state = np.repeat(np.arange(len(below[d])), self.degree[d])
            np.add.at(below[d], from_state, below[d + 1][self.target[d]])
        paths, state = np.empty((len(self.final[0]), 0), np.int64), np.arange(len(self.final[0]))
        for d in range(len(self.label)):
            arcs, many = _arcs(self.degree[d], state), self.degree[d][state]
            paths = np.c_[np.repeat(paths, many, axis=0), self.label[d][arcs]]
            state = self.target[d][arcs]
            yield d + 1, paths, below[d + 1][state]

    def compose(self, rows: np.ndarray) -> np.ndarray:
        """The counts along the path of every sequence: column d holds that of its first d + 1 symbols (0 where there is none)."""
        out = np.zeros(rows.shape, np.int64)
        state, on = np.zeros(len(rows), np.int64), np.full(len(rows), len(self.final[0]) > 0)
        base = np.int64(len(self.symbols) + 1)
        for d in range(min(rows.shape[1], len(self.label))):
            keys = np.repeat(np.arange(len(self.degree[d])), self.degree[d]) * base + self.label[d]
            if not len(keys):
                break
            want = state * base + rows[:, d]
            at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            on = on & (rows[:, d] >= 0) & (keys[at] == want)
            state = np.where(on, self.target[d][at], 0)
            out[:, d] = np.where(on, self.final[d + 1][state], 0)
        return out

    # One row of a table: symbols, and the levels one after another.
    SCHEMA = "symbols array<binary>, levels array<int>, final array<long>, degree array<int>, label array<int>, target array<int>"
    NAMES = ["symbols", "levels", "final", "degree", "label", "target"]

    def pack(self) -> list:
        used = np.unique(np.concatenate(self.label))
        small = np.full(len(self.symbols) + 1, -1, np.int64)
        small[used] = np.arange(len(used))
        return [self.symbols.take(pa.array(used)), [len(f) for f in self.final], np.concatenate(self.final), np.concatenate(self.degree),
                small[np.concatenate(self.label)], np.concatenate(self.target)]

    @classmethod
    def unpack(cls, symbols, levels, final, degree, label, target) -> Transducer:
        cut = np.cumsum(levels)[:-1]
        degrees = np.split(degree.astype(np.int64), cut)
        arcs = np.cumsum([d.sum() for d in degrees[:-1]])[:-1]
        return cls(symbols, np.split(final, cut), degrees, np.split(label.astype(np.int64), arcs), np.split(target.astype(np.int64), arcs))


def _ranked(symbols: pa.BinaryArray) -> tuple[pa.BinaryArray, np.ndarray]:
    """The distinct symbols in byte order, and the rank of each given one."""
    coded = symbols.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), rank[coded.indices.to_numpy()]


def _arcs(degree: np.ndarray, states: np.ndarray) -> np.ndarray:
    """Places of the arcs of ``states``, in their order."""
    start, many = (np.cumsum(degree) - degree)[states], degree[states]
    return np.repeat(start - (np.cumsum(many) - many), many) + np.arange(many.sum())


def _equal_states(final, degree, label, target) -> tuple[np.ndarray, np.ndarray]:
    """(states to keep, the kept state that each equals): the same count and the same arcs."""
    n = len(final)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    m = np.uint64(0x9E3779B97F4A7C15)
    place = np.arange(len(label)) - np.repeat(np.cumsum(degree) - degree, degree)
    h = (label.astype(np.uint64) * m ^ target.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9) + place.astype(np.uint64)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    mixed = final.astype(np.uint64) * m + degree.astype(np.uint64)
    np.add.at(mixed, np.repeat(np.arange(n), degree), h ^ (h >> np.uint64(32)))
    _, first, same = np.unique(mixed, return_index=True, return_inverse=True)
    twin = first[same]
    # Equal hashes are compared arc by arc.
    wrong = (final != final[twin]) | (degree != degree[twin])
    twin = np.where(wrong, np.arange(n), twin)
    mine, other = _arcs(degree, np.arange(n)), _arcs(degree, twin)
    differ = (label[mine] != label[other]) | (target[mine] != target[other])
    twin[np.repeat(np.arange(n), degree)[differ]] = np.repeat(np.arange(n), degree)[differ]
    keep, inverse = np.unique(twin, return_inverse=True)
    return keep, inverse


# ---------------------------------------------------------------- scan

class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def pair_slots(lang: np.ndarray, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two slots of the bit table for the hashes of a language and two words."""
    h = lang
    for x in (first, second):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + x
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return h >> np.uint64(64 - TABLE_BITS), (h >> np.uint64(64 - 2 * TABLE_BITS)) & np.uint64((1 << TABLE_BITS) - 1)


def chunk_windows(held: list[tuple[str, np.ndarray]], ids: dict, n_words: int, frequent: np.ndarray | None) -> tuple[pa.BinaryArray, np.ndarray]:
    """(symbols in byte order, windows of ranks) of a chunk: one window (language, word, ...) per word; with a table of
    frequent pairs only windows of three words or more whose pairs are all in it, cut where one is not."""
    langs = {lang: i for i, lang in enumerate(dict.fromkeys(lang for lang, _ in held))}
    symbols, rank = _ranked(pa.array([*ids, *(x.encode() for x in langs)], pa.binary()))
    if _BREAK in ids:
        rank[ids[_BREAK]] = -1
    flow = rank[np.concatenate([a for _, a in held])]
    lang = np.repeat([rank[len(ids) + langs[x]] for x, _ in held], [len(a) for _, a in held])
    cols = [lang, flow]
    for k in range(1, n_words):
        nxt = np.r_[flow[k:], np.full(min(k, len(flow)), -1)][:len(flow)]
        cols.append(np.where(cols[-1] >= 0, nxt, -1))
    rows = np.stack(cols, axis=1)
    rows = rows[rows[:, 1] >= 0]
    if frequent is not None and len(rows):
        h = np.fromiter(map(word_hash, symbols.to_pylist()), np.uint64, len(symbols))
        known = np.zeros(len(rows), bool)
        for k in range(1, n_words):
            pair = rows[:, k + 1] >= 0
            a, b = pair_slots(h[rows[:, 0]], h[rows[:, k]], h[rows[:, k + 1]])
            for s in (a, b):
                pair &= (frequent[(s >> np.uint64(3)).astype(np.int64)] >> (s & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            known = pair if k == 1 else known & pair
            rows[:, k + 1] = np.where(known, rows[:, k + 1], -1)
        rows = rows[rows[:, 3] >= 0]
    return symbols, rows


def cut_ranges(symbols: pa.BinaryArray, rows: np.ndarray, borders: list[tuple[bytes, ...]]) -> list[int]:
    """First row of each prefix range among sorted rows, and their number at the end."""
    if not borders:
        return [0, len(rows)]
    width = len(borders[0])
    word = lambda i: tuple(symbols[x].as_py() if x >= 0 else b"" for x in rows[i, :width].tolist())
    return [0, *(bisect_left(range(len(rows)), b, key=word) for b in borders), len(rows)]


def range_borders(keys: list[tuple[bytes, ...]], ranges: int, width: int) -> list[tuple[bytes, ...]]:
    """At most ``ranges - 1`` prefixes of ``width`` symbols that cut the sampled keys evenly."""
    keys = sorted(k[:width] for k in keys)
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []


def _scan(docs: DataFrame, n_words: int, borders, frequent, chunk: int) -> DataFrame:
    """(range, transducer) rows of the documents' windows, a row per chunk and prefix range."""
    sent = docs.sparkSession.sparkContext.broadcast((borders, frequent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders, frequent = sent.value
        if frequent is not None:
            frequent = np.frombuffer(frequent, np.uint8)
        ids, held, n = _Ids(), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            symbols, rows = chunk_windows(held, ids, n_words, frequent)
            rows, counts = sorted_counts(rows, np.ones(len(rows), np.int64))
            at = cut_ranges(symbols, rows, borders)
            for r, (lo, hi) in enumerate(zip(at, at[1:])):
                if lo < hi:
                    yield _packed(r, Transducer.build(symbols, rows[lo:hi], counts[lo:hi]))

        for b in batches:
            for lang, t in zip(b.column(0).to_pylist(), b.column(1)):
                ws = tokens(t.as_py())
                if not ws:
                    continue
                ws.append(_BREAK)
                held.append((lang, np.fromiter(map(ids.__getitem__, ws), np.int32, len(ws))))
                n += len(ws)
                if n >= chunk:
                    yield from flush()
                    ids, held, n = _Ids(), [], 0
        if n:
            yield from flush()

    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(run, f"range int, {Transducer.SCHEMA}")


def _packed(r: int, t: Transducer) -> pa.RecordBatch:
    symbols, levels, final, degree, label, target = t.pack()
    kinds = [pa.binary(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    cols = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, k)) for x, k in zip((symbols, levels, final, degree, label, target), kinds)]
    return pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), *cols], ["range", *Transducer.NAMES])


def _united(parts: DataFrame, ranges: int, min_count: int, shortest: int, collapse: int = 2_000_000) -> DataFrame:
    """(lang, gram, words, f) of the sequences of more than ``shortest`` words that are frequent, and of every language (0 words)
    its part of all words.  A range's transducers are united in one task, collapsed whenever ``collapse`` arcs are held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Transducer] = []
        now, size = None, 0

        def out() -> Iterator[pa.RecordBatch]:
            t = Transducer.union(held)
            for length, paths, f in t.prefixes():
                take = np.ones(len(f), bool) if length == 1 else (f >= min_count) & (length - 1 > shortest)
                used, at = np.unique(paths[take], return_inverse=True)
                names = t.symbols.take(pa.array(used)).cast(pa.string()).to_pylist()
                words = [[names[i] for i in p] for p in at.reshape(-1, length).tolist()]
                name, gram = [w[0] for w in words], [" ".join(w[1:]) for w in words]
                yield pa.RecordBatch.from_arrays([pa.array(name, pa.string()), pa.array(gram, pa.string()),
                                                  pa.array(np.full(len(name), length - 1, np.int32)), pa.array(f[take])], ["lang", "gram", "words", "f"])

        for b in batches:
            for i in range(b.num_rows):
                r = b.column(0)[i].as_py()
                if r != now and held:
                    yield from out()
                    held, size = [], 0
                now = r
                symbols, *arrays = (b.column(j)[i].values for j in range(1, 7))
                held.append(Transducer.unpack(symbols, *(a.to_numpy() for a in arrays)))
                size += len(arrays[3])
                if size >= collapse:
                    held = [Transducer.union(held)]
                    size = min(sum(map(len, held[0].label)), collapse // 2)
        if held:
            yield from out()

    return (parts.repartitionById(ranges, "range").sortWithinPartitions("range")  # a prefix range is a partition
            .mapInArrow(run, "lang string, gram string, words int, f long"))


def frequent_table(pairs: DataFrame) -> bytes:
    """The bit table of the pairs (lang, gram): its size is fixed, the driver gets at most one row per 64 bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [g.encode().split(b" ") for g in b.column(1).to_pylist()]
            hashes = [np.fromiter(map(word_hash, x), np.uint64, b.num_rows)
                      for x in ([lang.encode() for lang in b.column(0).to_pylist()], [w[0] for w in words], [w[1] for w in words])]
            s = np.concatenate(pair_slots(*hashes))
            yield pa.RecordBatch.from_arrays([pa.array((s >> np.uint64(6)).astype(np.int32)),
                                              pa.array((np.uint64(1) << (s & np.uint64(63))).view(np.int64))], ["place", "bits"])

    got = pairs.select("lang", "gram").mapInArrow(run, "place int, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(1 << (TABLE_BITS - 6), np.int64)
    out[got["place"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64)
    return out.tobytes()


def sampled_prefixes(docs: DataFrame) -> list[tuple[bytes, bytes, bytes]]:
    """(language, word, next word) at places of some documents, for the range borders only."""
    some = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").sample(min(1.0, SAMPLE_DOCS / max(1, docs.count())), seed=5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for lang, t in zip(b.column(0).to_pylist(), b.column(1)):
                ws = [w for w in tokens(t.as_py()) if w != _BREAK]
                step = max(1, len(ws) * SAMPLE_DOCS // SAMPLE_KEYS // 10)
                out += [(lang.encode(), x, y) for x, y in zip(ws[::step], ws[1::step])]
            out = out[::max(1, len(out) // 50 // max(1, b.num_rows))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in (zip(*out) if out else ([], [], []))], ["l", "a", "b"])

    rows = some.mapInArrow(run, "l binary, a binary, b binary").limit(SAMPLE_KEYS).collect()
    return [(bytes(r[0]), bytes(r[1]), bytes(r[2])) for r in rows]


def frequent_sequences(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, chunk: int = CHUNK, ranges: int | None = None) -> DataFrame:
    """(lang, gram, words, f): every sequence of up to ``max_words`` words that occurs ``min_count`` times, and with 0 words a language's words."""
    ranges = ranges or partitions(docs)
    sample = sampled_prefixes(docs)
    first = _united(_scan(docs, min(2, max_words), range_borders(sample, ranges, 2), None, chunk), ranges, min_count, 0)
    first = materialize(first, "phrases-short")
    if max_words < 3:
        return first
    known = frequent_table(first.where("words = 2"))
    longer = _united(_scan(docs, max_words, range_borders(sample, ranges, 3), known, chunk), ranges, min_count, 2)
    return first.unionByName(materialize(longer.where("words > 0"), "phrases-long"))


# ---------------------------------------------------------------- parts

def part_counts(grams: DataFrame, ranges: int | None = None) -> DataFrame:
    """(lang, gram, f, starts array<long>, ends array<long>) of the sequences of two words or more: the counts of their
    beginnings of 1, 2, ... words and of their ends of 1, 2, ... words, by composition with transducers of the frequent sequences.

    A sequence goes to its prefix range, and, as a part, to every range that holds a sequence that begins with it; these follow
    on each other, and a range gets at most ``max_words`` such parts from before it."""
    spark = grams.sparkSession
    ranges = ranges or partitions(grams)
    grams = grams.where("words > 0")
    total = max(1, grams.count())
    sample = grams.select("lang", "gram").sample(min(1.0, SAMPLE_KEYS / 2 / total), seed=5).limit(SAMPLE_KEYS).collect()
    seq = lambda lang, gram, back: (lang.encode(), *(gram.encode().split(b" ")[::-1] if back else gram.encode().split(b" ")))
    borders = {}
    for back in (False, True):
        keys = sorted(seq(r[0], r[1], back) for r in sample)
        borders[back] = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []
    sent = spark.sparkContext.broadcast(borders)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders = sent.value
        for b in batches:
            take, where, own = [], [], []
            for i, (lang, gram) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                for back in (False, True):
                    s = seq(lang, gram, back)
                    lo, hi = bisect_right(borders[back], s), bisect_right(borders[back], (*s, b"\xff\xff"))
                    for r in range(lo, hi + 1):
                        take.append(i)
                        where.append(2 * r + back)
                        own.append(r == lo)
            at = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(where, pa.int32()), pa.array(own, pa.bool_()), *(b.column(i).take(at) for i in range(3))],
                                             ["range", "own", "lang", "gram", "f"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now = None

        def out() -> Iterator[pa.RecordBatch]:
            back = bool(now % 2)
            seqs = [seq(lang, gram, back) for _, lang, gram, _ in held]
            lengths = np.array([len(x) for x in seqs])
            symbols, codes = _ranked(pa.array([s for x in seqs for s in x], pa.binary()))
            rows = np.full((len(seqs), lengths.max()), -1, np.int64)
            rows[np.arange(rows.shape[1]) < lengths[:, None]] = codes
            counts = np.array([f for *_, f in held], np.int64)
            along = Transducer.build(symbols, *sorted_counts(rows, counts)).compose(rows)
            own = [i for i, (mine, *_) in enumerate(held) if mine and len(seqs[i]) > 2]
            parts = [along[i, 1:len(seqs[i]) - 1].tolist() for i in own]
            none = [None] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array([held[i][1] for i in own], pa.string()), pa.array([held[i][2] for i in own], pa.string()),
                                              pa.array([held[i][3] for i in own], pa.int64()), pa.array(none if back else parts, pa.list_(pa.int64())),
                                              pa.array(parts if back else none, pa.list_(pa.int64()))], ["lang", "gram", "f", "starts", "ends"])

        for b in batches:
            for r, *row in zip(*(b.column(i).to_pylist() for i in range(5))):
                if r != now and held:
                    yield from out()
                    held = []
                now = r
                held.append(tuple(row))
        if held:
            yield from out()

    dealt = grams.select("lang", "gram", "f").mapInArrow(deal, "range int, own boolean, lang string, gram string, f long")
    found = (dealt.repartitionById(2 * ranges, "range").sortWithinPartitions("range")
             .mapInArrow(walk, "lang string, gram string, f long, starts array<long>, ends array<long>"))
    return found.groupBy("lang", "gram").agg(F.max("f").alias("f"), F.max("starts").alias("starts"), F.max("ends").alias("ends"))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP,
                 inside_percent: int = INSIDE_PERCENT, chunk: int = CHUNK, ranges: int | None = None) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases."""
    grams = frequent_sequences(docs, min_count, max_words, chunk, ranges)
    sizes = grams.where("words = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    parts = materialize(part_counts(grams, ranges).withColumn("w", F.split("gram", " ")), "phrases-parts")
    # The score of cutting after k words, for every k; the first of the lowest counts.
    cuts = F.transform("starts", lambda left, i: F.struct(left.alias("l"), F.element_at("ends", (F.size("starts") - i).cast("int")).alias("r"), i.alias("k")))
    scored = F.transform(cuts, lambda c: F.struct(
        F.call_function("div", F.lit(2_000_000).cast("decimal(38,0)") * F.col("f").cast("decimal(19,0)"),
                        c["l"].cast("decimal(20,0)") + c["r"].cast("decimal(20,0)")).cast("long").alias("score"), c["k"].alias("k"), c["l"].alias("l"), c["r"].alias("r")))
    parts = parts.select("lang", "gram", "w", F.col("f").alias("a"), F.array_min(scored).alias("best"))
    # Every phrase inside a longer one, with the count of the most frequent that holds it.
    inside = F.flatten(F.transform(F.sequence(F.lit(2), F.size("w") - 1), lambda k: F.transform(
        F.sequence(F.lit(1), F.size("w") - k + 1), lambda i: F.array_join(F.slice("w", i, k), " "))))
    longer = (parts.where(F.size("w") > 2).select(F.col("lang").alias("_lang"), F.explode(inside).alias("_gram"), "a")
              .groupBy("_lang", "_gram").agg(F.max("a").alias("_longer")))
    kept = (parts.join(longer, (F.col("lang") == F.col("_lang")) & (F.col("gram") == F.col("_gram")), "left")
            .where(F.col("_longer").isNull() | (F.col("_longer").cast("decimal(19,0)") * 100 < F.col("a").cast("decimal(19,0)") * inside_percent)))
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "gram")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return (ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), F.col("gram").alias("phrase"), "a",
                                              F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score")))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the 2000 best phrases of each language of all documents."""
    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                     '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
sizes AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, ws[i:i + k - 1] AS p, count(*) AS f FROM w, unnest([1, 2, 3, 4]) o(k), unnest(range(1, len(ws) - k + 2)) u(i) GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
  SELECT c.lang, c.p, c.f AS a, k, l.f AS l, r.f AS r, (2000000::HUGEINT * c.f // (l.f::HUGEINT + r.f))::BIGINT AS score
  FROM g c, unnest(range(1, len(c.p))) u(k)
  JOIN g l ON l.lang = c.lang AND l.p = c.p[1:k] JOIN g r ON r.lang = c.lang AND r.p = c.p[k + 1:len(c.p)]),
best AS (SELECT *, array_to_string(p, ' ') AS phrase FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_ AS (SELECT c.lang, c.p[i:i + k - 1] AS p, max(c.f) AS longer FROM g c, unnest([2, 3]) o(k), unnest(range(1, len(c.p) - k + 2)) u(i)
           WHERE k < len(c.p) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inner_ i ON i.lang = b.lang AND i.p = b.p WHERE i.longer IS NULL OR 100 * i.longer < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM kept JOIN sizes USING (lang) QUALIFY rank <= 2000
"""

QUERIES = {"op13_phrases": op13_phrases}
ORACLES = {"op13_phrases": SQL}
