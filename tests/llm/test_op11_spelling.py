import random
import zlib

import pytest

from tests.llm.conftest import same_rows
from tidemark.llm import op11_spelling as op


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def test_query_against_sql(spark):
    from tests.conftest import SF

    assert same_rows(op.op11_spelling(spark, SF), SF, op.SQL)


def made_words(n: int, shortest: int, seed: int) -> list[str]:
    """Words that share syllables, and words one edit away from them."""
    rng = random.Random(seed)
    parts = ["an", "er", "th", "ing", "é", "aa", "tion", "ß", "o", "anan"]
    words = set()
    while len(words) < n:
        w = "".join(rng.choices(parts, k=rng.randint(2, 6)))
        at = rng.randrange(len(w))
        for v in (w, w[:at] + w[at + 1:], w[:at] + "é" + w[at:], w[:at] + "a" + w[at + 1:]):
            if len(v) >= shortest:
                words.add(v)
    return sorted(words)


@pytest.mark.parametrize("shortest,threshold,longest", [(7, 3, 6), (7, 40, 4), (2, 10, 6), (4, 1, 3)])
def test_near_words_are_all_found(spark, shortest, threshold, longest):
    words = made_words(300, shortest, threshold)
    df = spark.createDataFrame([(i, w, 1) for i, w in enumerate(words)], "id long, word string, n long")
    got = {(min(r.a, r.b), max(r.a, r.b)) for r in op.near_words(df, longest, threshold, hot=20).collect()}
    assert got == {(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if one_edit(words[i], words[j])} and got


def test_dictionary_fits_and_is_closed(spark):
    df = spark.createDataFrame([(w,) for w in made_words(300, 7, 1)], "word string")
    free, tight = op.gram_dictionary(df, threshold=2), op.gram_dictionary(df, threshold=2, max_grams=150)
    assert len(free) > 150 >= len(tight) and all(len(g) == op.SHORTEST or g[:-1] in free for g in free)


def test_no_edit_affects_more_grams_than_the_bound():
    rng = random.Random(5)
    words = made_words(200, 7, 9)
    grams = {}
    for w in words:
        s = op.START + w + op.END
        for q in (2, 3, 4, 5):
            for i in range(len(s) - q + 1):
                if q == 2 or rng.random() < 0.3:
                    grams[s[i:i + q]] = 1
    g = op.Grams(grams)
    for w in words:
        q = op.longest_gram(len(w) - 1)
        cut = lambda x: [(op.START + x + op.END)[p:e] for p, e in g.cut(op.START + x + op.END, q)]
        s = op.START + w + op.END
        own = g.cut(s, q)
        bound = g.affected(s, own, q)
        assert bound < len(own)
        for i in range(len(w) + 1):
            for v in (w[:i] + w[i + 1:], w[:i] + "a" + w[i + 1:], w[:i] + "n" + w[i:]):
                left = cut(v)
                shared = 0
                for x in cut(w):
                    if x in left:
                        left.remove(x)
                        shared += 1
                assert v == w or shared >= len(own) - bound


def test_forms_and_roots(spark):
    docs = spark.createDataFrame([(1, "Receives " * 200 + "recieves " + "receive " * 20 + "receiv " * 2 + "recieves receivé receivé")], "doc_id long, text string")
    got = {r.word: r for r in op.variants(docs, min_length=6).collect()}
    # "recieves" swaps two letters, which is two edits.
    assert set(got) >= {"receives", "receive", "receiv"} and got["receive"].form == "receives" and got["receive"].form_n == got["receives"].n
    assert got["receiv"].form == "receive" and got["receiv"].root == "receives" and got["receives"].root == "receives" and got["receives"].form is None
    assert "recieves" not in got or got["recieves"].form is None


def test_dropped_letter():
    h = lambda i, r: zlib.crc32(f"{i}:{r}".encode())
    hit = next(i for i in range(1000) if h(i, "müller") % 31 == 0)
    at = h(hit, "müller") % 6
    assert op.misspelt(hit, "müller".encode()) == "müller"[:at] + "müller"[at + 1:]
    assert op.misspelt(next(i for i in range(99) if h(i, "müller") % 31), "müller".encode()) == "müller"


def test_odd_rows(spark, odd_docs, no_docs):
    got = op.variants(odd_docs, min_length=4).collect()
    assert {r.word for r in got} >= {"four", "five", "line", "word", "another"} - {"word"} and all(r.n >= 2 and r.root for r in got)
    assert op.variants(no_docs).count() == 0
    run = "ab" * 1_500
    long = spark.createDataFrame([(1, f"{run} {run}x {run} {run}x")], "doc_id long, text string")
    assert sorted(r.n_near for r in op.variants(long).collect()) == [1, 1]
