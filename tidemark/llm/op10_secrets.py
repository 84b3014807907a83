"""Secret scans: candidates by pattern, false positives removed by a random forest.

Candidates are runs of 16 or more ASCII letters, digits and ``+/_=-`` that hold a digit, and, whatever its signs and length, the value
assigned to a name of a password, token, secret or key (also as an option, in an element, an authorization header or an address): all up to the
end quote or, unquoted, to white space, a comma, a closing bracket or the next assignment (the texts are scanned whole).  Their features: length and make-up, how likely the character transitions are in the corpus, how much of the candidate
corpus words cover, the path, and the neighbouring words.  The transition counts and the word list come from one pass
over all documents (the counts are aggregates; the list is the ``DICTIONARY`` most frequent words of four letters or more).

The forest (Spark ML) is trained on ``FINDINGS`` labelled findings.  ``labelled_findings`` writes them from a seed: keys, tokens
and passwords in the ways they are assigned, and what scanners take for them (numbers, identifiers, checksums and
commits named as such, placeholders, slugs, dates); ``train`` takes any other table of labelled findings as well.

Nulls and ties: null and empty texts have no candidates; a null path has no path words; rows with a null doc_id and
rows that repeat are scanned each; findings of one document are told apart by their place; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
import random
import re
import string
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, table

FINDINGS = 6_000
DICTIONARY = 20_000
SEED = 5
TREES, DEPTH = 40, 9
CONTEXT = 48
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=\-])(?=[A-Za-z+/_=\-]*\d)[A-Za-z0-9+/_=\-]{16,}")
_NAMES = r"(?:passw(?:or)?d|passphrase|passwort|pwd|pass|secret|token|credentials?|api_?key|key|auth)s?"
#: What stands before a value: an assignment to a name, an option, an element's start tag, an authorization header, or a user in an address.
#: An unquoted value ends at white space, a comma or closing bracket, an end tag, or where ``;`` or ``&`` starts the next assignment.
ASSIGNED = re.compile(rf"""(?:{_NAMES}["'`\])]{{0,2}}[ \t]*(?::=|=>|={{1,3}}|:)[ \t]* | (?<![\w-])--?{_NAMES}[ \t]+ | <{_NAMES}>
                          | authorization["'`]{{0,2}}[ \t]*[:=][ \t]*["'`]?(?:bearer|basic|token)[ \t]+)
                          (?=(?P<quote>["'`])(?P<inside>[^\n]*?)(?:(?P=quote)|\n|\Z)
                             |(?P<plain>[^\s"'`,;)}}\]<](?:[^\s,;&)}}\]<]|<(?!/)|[;&](?![\w.$]*[:=]))*))
                          | ://[^\s/:@"'`<>]*:(?=(?P<user>[^\s@/"'`<>]+)@)""", re.I | re.X)
_WORD = re.compile(r"[^\W\d_]{4,}")
_NEAR = re.compile(r"[A-Za-z]+")
_SPACE = re.compile(r"\s")
# Words near a finding that speak for or against a secret, and words of test paths.
FOR = frozenset("secret secrets token tokens password passwd pwd pass key keys apikey api auth authorization bearer credential credentials private access client".split())
AGAINST = frozenset("commit sha md5 hash checksum digest id uuid guid isbn order number phone card account page version date file path url example sample placeholder build ref".split())
TEST_PATH = frozenset("test tests example examples sample samples fixture fixtures doc docs mock demo".split())
# End of fixed values.
SYMBOLS = 38  # a to z, 0 to 9, other ASCII candidate signs, everything else
_SYMBOL = bytes((c - 97) if 97 <= c <= 122 else (c - 65) if 65 <= c <= 90 else (26 + c - 48) if 48 <= c <= 57 else 36 if chr(c) in "+/_=-" else 37 for c in range(256))
FEATURES = ("length", "digits", "upper", "lower", "signs", "hex", "entropy", "distinct", "transitions", "worst_transitions", "switches",
            "dictionary", "longest_run", "parts", "equals", "quoted", "for_near", "against_near", "for_any", "against_any", "test_path", "prefix")


def corpus_statistics(texts: DataFrame) -> tuple[list[float], frozenset[str]]:
    """(log transition probabilities, SYMBOLS x SYMBOLS; frequent words) over all texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, words = np.zeros(SYMBOLS * SYMBOLS, np.int64), Counter()

        def out(with_pairs: bool):
            at = np.flatnonzero(pairs) if with_pairs else np.empty(0, np.int64)
            named = list(words.items())
            words.clear()
            return pa.RecordBatch.from_arrays([pa.array([None] * len(at) + [w for w, _ in named], pa.string()),
                                               pa.array(at.tolist() + [None] * len(named), pa.int32()),
                                               pa.array(pairs[at].tolist() + [n for _, n in named], pa.int64())], ["word", "pair", "n"])

        for b in batches:
            for t in b.column(0):
                t = t.as_py()
                if not t:
                    continue
                words.update(_WORD.findall(t.lower()))
                s = np.frombuffer(t.encode("utf-8", "surrogatepass").translate(_SYMBOL), np.uint8).astype(np.int32)
                pairs += np.bincount(s[:-1] * SYMBOLS + s[1:], minlength=len(pairs))
            if len(words) > 300_000:
                yield out(False)
        yield out(True)

    counts = materialize(texts.mapInArrow(count, "word string, pair int, n long").groupBy("word", "pair").agg(F.sum("n").alias("n")), "secret-counts")
    pairs = np.ones(SYMBOLS * SYMBOLS)  # one of each, so that no transition is impossible
    for r in counts.where("pair IS NOT NULL").select("pair", "n").collect():  # SYMBOLS * SYMBOLS rows at most
        pairs[r["pair"]] += r["n"]
    table_ = pairs.reshape(SYMBOLS, SYMBOLS)
    log = np.log(table_ / table_.sum(axis=1, keepdims=True))
    words = counts.where("word IS NOT NULL").orderBy(F.desc("n"), "word").limit(DICTIONARY).select("word").collect()
    return log.ravel().tolist(), frozenset(r["word"] for r in words)


def covered(candidate: str, words: frozenset[str]) -> float:
    """Share of the candidate's signs that lie in a dictionary word."""
    low = candidate.lower()
    mark = bytearray(len(low))
    for part in _WORD.finditer(low):
        s, e = part.span()
        for i in range(s, e - 3):
            for j in range(min(e, i + 14), i + 3, -1):
                if low[i:j] in words:
                    mark[i:j] = b"\1" * (j - i)
                    break
    return sum(mark) / len(low)


def places(text: str) -> list[tuple[int, int]]:
    """(start, end) of the candidates of a text: the assigned values, and the runs outside of them and of their names.  A value of
    several words in quotes is searched inside as well; no other candidates overlap, so a text is read a few times at most."""
    found, at = set(), 0
    while True:
        m = ASSIGNED.search(text, at)
        found.update(r.span() for r in CANDIDATE.finditer(text, at, m.start() if m else len(text)))
        if not m:
            return sorted(found)
        s, e = m.span("inside" if m["quote"] else "plain" if m["plain"] else "user")
        while not m["quote"] and e > s and text[e - 1] in ",;)]}\"'`":  # what ends a statement is no part of the value
            e -= 1
        if e > s and not text[s:e].isspace():
            found.add((s, e))
        at = max(m.end(), s if m["quote"] and _SPACE.search(text, s, e) else e)


def features(candidate: str, before: str, after: str, path: str | None, log: list[float], words: frozenset[str]) -> list[float]:
    n = len(candidate)
    count = Counter(candidate)
    digits, upper, lower = (sum(map(f, candidate)) for f in (str.isdigit, str.isupper, str.islower))
    signs = candidate.encode("utf-8", "surrogatepass").translate(_SYMBOL)
    steps = [log[a * SYMBOLS + b] for a, b in zip(signs, signs[1:])]
    kinds = [c.isdigit() + 2 * c.isupper() + 4 * c.islower() for c in candidate]
    run = best = 1
    for a, b in zip(candidate, candidate[1:]):
        run = run + 1 if a == b or ord(b) - ord(a) == 1 else 1
        best = max(best, run)
    near = [x.lower() for x in _NEAR.findall(before)]
    close, tail = set(near[-2:]), before.rstrip(" \t\"'`")
    every = set(near) | {x.lower() for x in _NEAR.findall(after)}
    parts = [p for p in re.split(r"[+/_=\-]+", candidate) if p]
    return [float(n), digits / n, upper / n, lower / n, 1 - (digits + upper + lower) / n, sum(c in "0123456789abcdefABCDEF" for c in candidate) / n,
            -sum(k / n * math.log2(k / n) for k in count.values()), len(count) / n, sum(steps) / max(1, len(steps)),
            sum(sorted(steps)[:8]) / max(1, min(8, len(steps))), sum(a != b for a, b in zip(kinds, kinds[1:])) / n, covered(candidate, words), best / n,
            len(parts) / n, float(tail.endswith(("=", ":", "=>"))), float(before.endswith(("\"", "'", "`")) and after[:1] in ("\"", "'", "`")),
            float(not FOR.isdisjoint(close)), float(not AGAINST.isdisjoint(close)), float(not FOR.isdisjoint(every)), float(not AGAINST.isdisjoint(every)),
            float(not TEST_PATH.isdisjoint(_NEAR.findall((path or "").lower()))), float(candidate[:4].isupper() or candidate[2:5].find("_") >= 0)]


def labelled_findings(count: int = FINDINGS, seed: int = SEED, words: frozenset[str] = frozenset()) -> list[tuple[str, str, str, str, int]]:
    """(candidate, before, after, path, label): secrets and what is taken for them, in equal numbers."""
    rng = random.Random(seed)
    plain = sorted(w for w in words if w.isascii())[:4000] or ["alpha", "river", "stone", "window", "garden", "paper", "thread", "market"]
    hexa, b64 = "0123456789abcdef", string.ascii_letters + string.digits + "+/"
    chars = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    text = lambda n: " ".join(rng.choice(plain) for _ in range(n))

    def secret():
        kind = rng.randrange(10)
        if kind < 2:
            return chars(hexa, rng.choice([24, 32, 40, 40, 48, 64]))
        if kind == 2:
            return chars(b64, rng.choice([20, 24, 32, 40, 44, 64])) + rng.choice(["", "=", "=="])
        if kind == 3:
            return rng.choice(["AKIA", "ASIA"]) + chars(string.ascii_uppercase + string.digits, 16)
        if kind == 4:
            return rng.choice(["ghp_", "gho_", "sk_live_", "xoxb-", "rk_live_", "glpat-"]) + chars(string.ascii_letters + string.digits, rng.randint(20, 36))
        if kind == 5:
            return chars(string.ascii_letters + string.digits + "-_", rng.randint(18, 43))
        if kind == 6:
            return chars(hexa.upper(), rng.choice([32, 40]))
        if kind == 7:  # a word with other signs in it
            w = "".join({"o": "0", "e": "3", "a": "4", "i": "1", "s": "$"}.get(c, c) if rng.random() < 0.6 else c for c in rng.choice(plain).title())
            return w + rng.choice("!@#$%&*.?") + chars(string.digits, rng.randint(1, 4))
        if kind == 8:
            return chars(string.ascii_letters + string.digits, 6) + rng.choice("!@#$%^&*.?") + chars(string.ascii_letters + string.digits + "!@#$%^&*.?", rng.randint(1, 12))
        return chars(rng.choice([string.ascii_letters, string.ascii_lowercase, string.ascii_uppercase]), rng.randint(16, 40))

    def decoy():
        kind = rng.randrange(13)
        if kind > 9:  # assigned words, references and placeholders
            said = rng.choice(["password", "token", "secret", "key", "api_key", "Key", "auth_token"]) + rng.choice([" = ", "=", ": ", ": "])
            if kind == 10:
                return rng.choice(plain) + rng.choice(["", "", ".", "?"]), said
            if kind == 11:
                w = rng.choice(plain)
                return rng.choice([f"${{{w.upper()}}}", f"${w.upper()}", f"os.environ['{w.upper()}']", f"config.{w}", f"self.{w}", f"args.{w}", f"get_{w}()", f"<{w}>", f"{{{w}}}", f"your_{w}"]), said
            if rng.random() < 0.2:
                said = rng.choice(["<key>", "<token>", "--key ", "--token ", f"http://{text(1)}:"])
            return rng.choice(["None", "null", "true", "false", "string", "required", "changeme", "********", "xxxxxxxx", "...", "%s", "password", "-", "0", "1", str(rng.randint(2, 9999))]), said
        if kind == 0:
            return chars(string.digits, rng.choice([16, 16, 18, 20])), rng.choice([text(3) + " ", "card ", "phone: ", "order number "])
        if kind == 1:
            return str(uuid.UUID(int=rng.getrandbits(128))), rng.choice(["id: ", "uuid=", text(2) + " ", "request id "])
        if kind == 2:
            return chars(hexa, 40), rng.choice(["commit ", "sha1: ", "sha ", "checksum = ", "git ref "])
        if kind == 3:
            return chars(hexa, rng.choice([32, 64])), rng.choice(["md5 ", "md5sum: ", "sha256 digest ", "hash: ", "checksum "])
        if kind == 4:
            return rng.choice("x0aXz1") * rng.randint(16, 30) + str(rng.randint(0, 9)), rng.choice(["token = \"", "password: ", "api_key="])
        if kind == 5:
            return rng.choice(["0123456789abcdef", "1234567890123456", "abcdefghijklmnop1", "your-api-key-here-1", "insert_token_here_0", "my_secret_token_123"]), rng.choice(["token = \"", "key: ", "secret="])
        if kind == 6:
            return rng.choice("-_").join(rng.choice(plain) for _ in range(rng.randint(3, 6))) + f"-{rng.randint(1, 99)}", text(3) + " "
        if kind == 7:
            return f"20{rng.randint(10, 29)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}T{rng.randint(10, 23)}-{rng.randint(10, 59)}-00", rng.choice(["date: ", "version ", text(2) + " "])
        if kind == 8:
            return "/" + "/".join(rng.choice(plain) for _ in range(rng.randint(3, 5))) + f"/{rng.randint(1, 99)}", rng.choice(["path ", "file: ", text(2) + " "])
        return (text(1) + text(1) + text(1)).replace(" ", "")[:30].ljust(16, "e") + str(rng.randint(1, 2000)), text(3) + " "

    out = []
    for i in range(count):
        path = rng.choice(["src/app", "config/prod", "web", "notes", "docs/guide", "tests/unit", "news"])
        if i % 2:
            name = rng.choice(["token", "secret", "password", "api_key", "apikey", "auth_token", "client_secret", "access_key", "key", "credential"])
            name = rng.choice([name, name.upper(), name.title()])
            sep, quote = rng.choice([" = ", "=", ": ", " := ", " => "]), rng.choice(["\"", "'", ""])
            before = rng.choice([f"{text(3)} {name}{sep}{quote}", f"{name}{sep}{quote}", f"{text(2)}\n{name}{sep}{quote}"])
            if rng.random() < 0.12:
                before, quote = rng.choice([("Authorization: Bearer ", ""), ("Authorization: token ", ""), (f"--{name} ", ""), (f"<{name}>", f"</{name}>"),
                                            (f"{rng.choice(['https', 'postgres', 'amqp'])}://{text(1)}:", f"@{text(1)}.example.com")])
            out.append((secret(), before, quote + " " + text(3), path, 1))
        else:
            c, before = decoy()
            quoted = before.endswith("\"")
            out.append((c, before if rng.random() < 0.5 else f"{text(2)} {before}", ("\"" if quoted else "") + " " + text(3), path, 0))
    return out


def train(spark: SparkSession, findings: list[tuple[str, str, str, str, int]], log: list[float], words: frozenset[str]) -> RandomForestClassificationModel:
    rows = [(features(*f[:4], log, words), float(f[4])) for f in findings]
    data = spark.createDataFrame(rows, "x array<double>, label double").coalesce(4)
    data = data.select(array_to_vector("x").alias("features"), "label")
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(data)


def candidates(docs: DataFrame, path: Column, log: list[float], words: frozenset[str]) -> DataFrame:
    """(doc_id, place, length, candidate, x array<double>) of every candidate."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, place, found, x = [], [], [], []
            for i, t, p in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                t = t.as_py()
                for s, e in places(t) if t else ():
                    ids.append(i)
                    place.append(s)
                    found.append(t[s:e])
                    x.append(features(t[s:e], t[max(0, s - CONTEXT):s], t[e:e + CONTEXT], p, log, words))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(place, pa.int64()), pa.array(found, pa.string()),
                                              pa.array(x, pa.list_(pa.float64()))], ["doc_id", "place", "candidate", "x"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", path.cast("string").alias("path"))
    return rows.mapInArrow(scan, "doc_id long, place long, candidate string, x array<double>")


def scan_secrets(docs: DataFrame, path: Column) -> DataFrame:
    """(doc_id, place, length, candidate, probability, secret) of every candidate of every row."""
    log, words = corpus_statistics(docs.select("text"))
    model = train(docs.sparkSession, labelled_findings(words=words), log, words)
    found = candidates(docs, path, log, words).withColumn("features", array_to_vector("x"))
    scored = model.transform(found).withColumn("probability", F.element_at(vector_to_array("probability"), 2))
    return scored.select("doc_id", "place", F.length("candidate").alias("length"), "candidate", "probability", (F.col("prediction") == 1).alias("secret"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of the documents (source as the path), its digest instead of its text, and the forest's verdict."""
    got = scan_secrets(table(spark, sf_dir, "documents"), F.col("source"))
    return got.select("doc_id", "place", "length", F.sha2("candidate", 256).alias("sha256"), F.round("probability", 6).alias("probability"), "secret")


QUERIES = {"op10_secrets": op10_secrets}
ORACLES: dict[str, str] = {}
