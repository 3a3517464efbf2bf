"""Spelling variants against comparing every word with every other."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as driver
from layerkit.llm import spelling


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts):
    """{(word, n, n_near, form, form_n, root)}; near words by the deletions and replacements they share."""
    near, holes = defaultdict(set), defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            short = w[:i] + w[i + 1 :]
            holes[i, short].add(w)
            if short in counts:
                near[w].add(short)
                near[short].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    forms = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best and counts[best] >= 2 * n else None

    def root(w):
        while forms[w]:
            w = forms[w]
        return w

    return {(w, n, len(near[w]), forms[w], counts.get(forms[w]), root(w)) for w, n in counts.items()}


def rows_of(df):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def table(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(3)


@pytest.mark.parametrize("letters, branch", [("ab", 4), ("aeiourst", 8), ("éàÿaq\U0001f600", 1 << 20)])
def test_equals_plain(spark, letters, branch):
    """Two letters make branches that no head divides; other alphabets words of one group."""
    rng = random.Random(7)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(5, 8))) for _ in range(400)}
    counts = {w: rng.choice([3, 4, 6, 12, 40, 100, 1000]) for w in sorted(words)}
    assert rows_of(spelling.variants(table(spark, counts), branch=branch)) == plain(counts)


def test_long_words_chains_ties_and_an_empty_table(spark):
    long = "a" * 5000 + "b" * 20
    counts = {long: 3, long + "c": 9, long[:-1] + "x": 9, "q" * 40: 3, "q" * 41: 4, "a" * 17: 8, "a" * 16: 5, "a" * 18: 3}
    # a chain of forms, each twice as frequent, that ends in a word of its own
    chain = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb", "bbbbbb", "bbbbbbb", "cbbbbbb"]
    counts |= {w: 3 << i for i, w in enumerate(chain)}
    counts |= {"tiesx": 8, "tiesy": 8, "ties": 3, "tiesz": 4}
    got = spelling.variants(table(spark, counts))
    assert rows_of(got) == plain(counts)
    assert {r.word: r.root for r in got.collect()}["aaaaa"] == "cbbbbbb"
    assert spelling.variants(table(spark, {"alone": 3})).first().root == "alone"
    assert spelling.variants(table(spark, counts).limit(0)).count() == 0


def test_budget_finds_every_pair_once():
    rng = np.random.default_rng(3)
    vectors = np.unique(rng.integers(0, 3, (300, spelling.GROUPS)) * (rng.random((300, spelling.GROUPS)) < 0.2), axis=0)
    vectors = vectors[np.lexsort(vectors.T[::-1])]
    q, leaf = spelling.candidates(vectors, vectors)
    got = Counter(zip(q.tolist(), leaf.tolist()))
    want = Counter()
    for i, a in enumerate(vectors):
        for j, b in enumerate(vectors):
            change = b - a
            plus, minus = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
            if len(plus) + len(minus) == np.count_nonzero(change) and len(plus) <= 1 and len(minus) <= len(plus):
                if not len(minus) or plus[0] < minus[0]:
                    want[i, j] += 1
    assert got == want and len(want) > len(vectors)


def test_one_edit():
    rng = random.Random(2)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(120)] + ["a" * 3000, "a" * 3001, "a" * 2999 + "b"]
    pairs = [(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if 0 <= len(b) - len(a) <= 1 and a != b]
    codes = spelling._codes(words)
    got = spelling.one_edit(codes, codes, np.array([i for i, _ in pairs]), np.array([j for _, j in pairs]))
    assert got.tolist() == [one_edit(words[i], words[j]) for i, j in pairs]


def counted(docs):
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def test_words(spark):
    text = "Éclair ÉCLAIR éclair x×÷y Straße STRASSE " * 40
    docs = [(1, text), (2, None), (3, ""), (2, text), (4, "word" * 30_000 + " " + "abcdef " * 3)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "doc_id AS word", "text AS n")
    got = spelling.vocabulary(spelling.runs(df, dropped=97))
    assert {r.word: r.n for r in got.collect()} == counted(docs)
    whole = {r.word: r.n for r in spelling.vocabulary(spelling.runs(df)).collect()}
    assert whole == {"Éclair": 160, "éclair": 80, "straße": 80, "strasse": 80, "abcdef": 3}


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = driver.queries()["op11_spelling_variants"](spark, sf)
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    assert rows_of(got) == plain(counted(docs))
