import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import same_rows
from tidemark.llm import op13_phrases as op


def test_query_against_sql(spark):
    from tests.conftest import SF

    assert same_rows(op.op13_phrases(spark, SF), SF, op.SQL)


def brute(docs, min_count, top):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang, text = lang or "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            ws = re.findall("[^ \t]+", piece)
            n[lang] += len(ws)
            f.update((lang, *ws[i:i + k]) for k in range(1, 5) for i in range(len(ws) - k + 1))
    found = {}
    for (lang, *p), a in f.items():
        if len(p) < 2 or a < min_count:
            continue
        cuts = [(2_000_000 * a // (f[lang, *p[:k]] + f[lang, *p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        found[lang, " ".join(p)] = (lang, " ".join(p), a, f[lang, *p[:k]], f[lang, *p[k:]], n[lang], score)
    gone = {(lang, " ".join(q)) for (lang, p), row in found.items() for ws in [p.split(" ")] for k in range(2, len(ws))
            for i in range(len(ws) - k + 1) for q in [ws[i:i + k]] if 100 * row[2] >= 80 * found[lang, " ".join(q)][2]}
    kept = [row for key, row in found.items() if key not in gone]
    out = []
    for lang in {r[0] for r in kept}:
        mine = sorted((r for r in kept if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        out += [(r[0], i + 1, *r[1:]) for i, r in enumerate(mine)]
    return sorted(out)


def made_docs(seed: int):
    rng = random.Random(seed)
    words = ["New", "york", "city", "of", "the", "é", "a b", "😀", "x\x1cy", "THE", "bill"]
    docs = []
    for _ in range(150):
        ws = rng.choices(words, weights=range(11, 0, -1), k=rng.randint(0, 40))
        docs.append((rng.choice(["en", "en", "de", None, "und"]), "".join(w + rng.choice([" ", " ", " ", "\t", ". ", ",", "\n", "  "]) for w in ws)))
    return docs + [("en", None), (None, ""), ("fr", " \n\t.")] + [("en", "one very common passage of words")] * 100


@pytest.mark.parametrize("chunk,ranges,min_count", [(50, 7, 5), (100_000, 1, 5), (300, 3, 2)])
def test_collocations_against_brute_force(spark, chunk, ranges, min_count):
    docs = made_docs(chunk)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3)
    got = sorted(tuple(r) for r in op.collocations(df, min_count=min_count, top=40, chunk=chunk, ranges=ranges).collect())
    assert got == brute(docs, min_count, 40) and len(got) > 40


def test_transducer_is_minimal_and_keeps_counts():
    rng = np.random.default_rng(3)
    parts, want = [], Counter()
    for _ in range(4):
        rows = rng.integers(0, 4, (400, 4))
        rows[np.arange(4) >= rng.integers(1, 5, 400)[:, None]] = -1
        names = sorted(rng.choice([b"a", b"bb", b"\xc3\xa9", b"c", b"d"], 4, replace=False).tolist())
        for r in rows:
            want[tuple(names[i] for i in r if i >= 0)] += 1
        rows, counts = op.sorted_counts(rows, np.ones(400, np.int64))
        t = op.Transducer.build(pa.array(names, pa.binary()), rows, counts)
        parts.append(op.Transducer.unpack(*(np.array(x) if i else x for i, x in enumerate(t.pack()))))
        for d in range(5):  # no two states of a depth are equal
            at = np.r_[0, np.cumsum(t.degree[d])]
            states = [(t.final[d][i], *((t.label[d][j], t.target[d][j]) for j in range(at[i], at[i + 1]))) for i in range(len(t.final[d]))] if d < 4 else t.final[d].tolist()
            assert len(set(states)) == len(states)
    whole = op.Transducer.union(parts)
    names = whole.symbols.to_pylist()
    rows, counts = whole.sequences()
    assert {tuple(names[i] for i in r if i >= 0): c for r, c in zip(rows, counts)} == want
    prefix = Counter()
    for s, c in want.items():
        for k in range(1, len(s) + 1):
            prefix[s[:k]] += c
    assert {tuple(names[i] for i in p): c for _, ps, cs in whole.prefixes() for p, c in zip(ps, cs)} == prefix
    along = whole.compose(rows)
    for r, a in zip(rows, along):
        s = [names[i] for i in r if i >= 0]
        assert a.tolist() == [want[tuple(s[:k + 1])] if k < len(s) else 0 for k in range(4)]


def test_pair_table_lets_all_frequent_pairs_through(spark):
    df = spark.createDataFrame([("en", f"w{i} é{i}") for i in range(500)], "lang string, gram string")
    table = np.frombuffer(op.frequent_table(df), np.uint8)
    h = lambda x: np.array([op.word_hash(x.encode())], np.uint64)
    for i in range(500):
        for s in op.pair_slots(h("en"), h(f"w{i}"), h(f"é{i}")):
            assert table[int(s[0]) >> 3] >> (int(s[0]) & 7) & 1


def test_odd_rows(odd_docs, no_docs):
    got = {(r.lang, r.phrase): r for r in op.collocations(odd_docs, min_count=2).collect()}
    assert got["en", "a line alone"].a == 2 and ("und", "two three four five") not in got and all(r.n >= r.a >= 2 for r in got.values())
    assert op.collocations(no_docs).count() == 0
