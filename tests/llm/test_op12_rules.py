import random
import re
from collections import Counter
from fractions import Fraction
from math import comb

from tests.llm.conftest import same_rows
from tidemark.llm import op12_rules as op


def test_query_against_sql(spark):
    from tests.conftest import SF01

    assert same_rows(op.op12_rules(spark, SF01), SF01, op.SQL)


def plain(text):
    words = re.findall(r"[^ \t-\r]+", text or "")
    runs = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if runs[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^ \t-\r]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside), len(lines))


def test_measures_against_plain_loops():
    rng, hashes = random.Random(1), op._Hashes()
    for n in list(range(30)) + [200] * 40:
        text = "".join(rng.choice(["a", "b", "é😀", "#$", "x\x1cy", "\x85"]) + rng.choice([" ", " ", "\t", "\n", "\x0b", "\r\n", "  "]) for _ in range(n))
        for t in (text, text + text[: len(text) // 2], f"\n \n{text}\n\n"):
            assert op.measure(t, hashes) == plain(t)
    assert op.measure(None, hashes) == (0,) * 6


def test_binomial_bound_is_exact():
    for n in (1, 7, 60, 400):
        for p in (Fraction(1, 20), Fraction(1, 3), Fraction(9, 10)):
            total = Fraction(0)
            for k in range(n + 1):
                total += comb(n, k) * p**k * (1 - p) ** (n - k)
                assert abs(op.binomial_cdf(k, n, float(p)) - float(total)) < 1e-10
    assert op.binomial_cdf(-1, 5, 0.1) == 0 and op.binomial_cdf(50_000, 1_000_000, 0.05) > 0.5 > op.binomial_cdf(49_900, 1_000_000, 0.05) > 0.3


def made(spark, seed, good_with_symbols, n=3000):
    """Good documents, some with symbols, and poor ones full of them; half of the languages have few labels."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        good, lang = rng.random() < 0.7, rng.choice(["en", "en", "en", None, "de"])
        ws = [rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) + str(rng.randrange(1000)) for _ in range(60)]
        share = (rng.random() < good_with_symbols[lang]) if good else 1
        docs.append((i, " ".join(w + "#" * (share and rng.randint(1, 2)) for w in ws), lang))
        if lang != "de" or i % 20 == 0:
            labels.append((i, int(good)))
    return spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int"), dict(labels)


def test_limit_holds_per_stratum(spark):
    docs, labels, known = made(spark, 3, {"en": 0.0, None: 0.3, "de": 0.0})
    rows = {r.doc_id: r for r in op.judged(docs, labels, op.F.col("lang")).collect()}
    wrong = Counter(r.stratum for r in rows.values() if known.get(r.doc_id) == 1 and not r.kept)
    right = Counter(r.stratum for r in rows.values() if known.get(r.doc_id) == 0 and not r.kept)
    size = Counter(r.stratum for r in rows.values() if known.get(r.doc_id) == 1)
    # English is safe to cut; where a third of the good have symbols nothing is, nor with a handful of labels.
    assert wrong["en"] <= 0.05 * size["en"] and right["en"] > 0.9 * sum(known.get(r.doc_id) == 0 for r in rows.values() if r.stratum == "en")
    assert all(r.kept != r.base_failed for r in rows.values() if r.stratum in (None, "de"))


def test_accepted_steps_are_those_before_the_first_failure(spark):
    docs, labels, _ = made(spark, 8, {"en": 0.04, None: 0.0, "de": 0.0})
    rows = op.measured(docs, op.F.col("lang"))
    steps = sorted(op.thresholds(rows, labels).collect(), key=lambda r: (r.stratum or "", r.step))
    strata = len({r.stratum for r in rows.join(labels, "doc_id").collect()})
    assert steps and strata == 3
    for lang in {r.stratum for r in steps}:
        ok = True
        mine = [r for r in steps if r.stratum == lang]
        assert [r.step for r in mine] == list(range(1, len(mine) + 1)) and [r.lift for r in mine] == sorted((r.lift for r in mine), reverse=True)
        for r in mine:
            tail = sum(comb(r.good, i) * 0.05**i * 0.95 ** (r.good - i) for i in range(r.rejected + 1)) if r.good > r.rejected else 1
            ok = ok and tail <= 0.05 / strata
            assert abs(r.p_value - tail) < 1e-9 and r.accepted == ok


def test_true_rate_is_kept_over_many_draws(spark):
    """Of repeated draws where good documents are rejected at the limit itself, hardly any accepts the cutoff."""
    import numpy as np

    rng = np.random.default_rng(4)
    accepted = sum(op.binomial_cdf(int(k), 500, op.LIMIT) <= op.DELTA for k in rng.binomial(500, op.LIMIT, 4000))
    assert accepted <= 4000 * op.DELTA * 1.2


def test_odd_rows(spark, odd_docs, no_docs, labels):
    got = op.judged(odd_docs, labels, op.F.col("lang")).collect()
    assert len(got) == odd_docs.count() and all(r.kept is not None for r in got)
    assert [r.n_words for r in got if r.doc_id == 7] == [40_000] and all(r.base_failed for r in got if r.n_words < 20)
    kept = op.keep_good(odd_docs, labels, op.F.col("lang"))
    assert kept.columns == odd_docs.columns and kept.count() == sum(r.kept for r in got)
    assert op.keep_good(no_docs, labels, op.F.col("lang")).count() == 0
    bare = op.judged(odd_docs, labels.limit(0), op.F.col("lang")).collect()
    assert all(r.kept != r.base_failed for r in bare)
