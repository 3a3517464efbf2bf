"""Personal data against the plain patterns, and what contexts add."""

import hashlib
import random
import re

import pytest

import __spark_entry__ as driver
from layerkit.llm import contextual_pii as pii

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = "".join(c for c in value if c in "0123456789")
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return True


def plain(text):
    out = []
    for k, (kind, form) in enumerate(FORMS.items()):
        out += [(m.start(), k, m.end()) for m in re.finditer(form, text or "") if passes(kind, m.group())]
    return sorted(out)


def line(spans):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(5)
    for marks in ("@.a1_", "+0123 ()-.", "1234.25 -", "a@b.c-%_ 1+", "49é \n.@+("):
        for _ in range(3000):
            text = "".join(rng.choice(marks) for _ in range(rng.randint(0, 40)))
            assert pii.base_spans(text) == plain(text), repr(text)
    for known in ("a@b.c_x@d.e", "a@b@c.de", "@x.y", "1.2.3.4.5.6.7.8", "0255.1.1.001", "256.1.1.1.1", "4111 1111 1111 1111", "+1 (23) 456-7890-"):
        assert pii.base_spans(known) == plain(known), known


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "+1" * 100_000, "a@" * 100_000, "(at)" * 50_000, "1 " * 150_000):
        base = pii.base_spans(text)
        pii.other_spans(text, base)


def test_other_spans():
    text = "call 555 0199 22, mail bob (at) ex [dot] com or eve at ex dot org, see 2001:db8::1; +1 (988) 555-2485 x1 4111111111111112"
    base = pii.base_spans(text)
    found = {text[a:b]: shapes for a, shapes, b in pii.other_spans(text, base)}
    assert found == {"555 0199 22": 8, "bob (at) ex [dot] com": 1, "eve at ex dot org": 1, "2001:db8::1": 2, "4111111111111112": 4}


def corpus():
    """Numbers behind a telling phrase, others behind phrases that tell nothing or another kind."""
    rng = random.Random(1)
    docs = []
    for i in range(40):
        number = "".join(rng.choice("0123456789") for _ in range(7))
        docs.append(f"It was late. Please ring me on +44 20 {number}, thanks from person {i}.")
        docs.append(f"our parcel code {number}{i:02d} was sent")
    docs += ["please  RING me on 020 794 6000 tonight", "parcel code 020 794 6001 was sent", "we ring me on monday 12"]
    docs += [f"write to user{i}@mail.example.org soon" for i in range(20)] + ["write to jo (at) mail (dot) org soon"]
    return docs


def test_patterns_tell_of_unseen_identifiers(spark):
    docs = corpus()
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r for r in pii.personal_data(df).collect()}
    told = {i: [(docs[i][s.start : s.end], pii.KINDS[s.kind]) for s in r.learned] for i, r in got.items() if r.learned}
    assert sorted(sum(told.values(), [])) == [("020 794 6000", "phone"), ("jo (at) mail (dot) org", "email")]
    assert all([tuple(s) for s in r.base] == plain(docs[i]) for i, r in got.items())
    # copies of one seed are one instance and prove nothing
    copies = [(i, f"dial 0{i % 2}" if i % 2 else "kindly dial +44 20 1234567") for i in range(60)] + [(90, "kindly dial 020 794 6000")]
    assert all(not r.learned for r in pii.personal_data(spark.createDataFrame(copies, "doc_id bigint, text string")).collect())


def test_scores_by_hand(spark):
    # pattern 1: four seeds; pattern 2: three seeds and the string that pattern 1 has as well; pattern 3: two seeds
    rows = [(3, 0, v, 1) for v in range(10, 14)] + [(-1, 8, 50, 1)]
    rows += [(3, 0, v, 2) for v in range(20, 23)] + [(-1, 8, 50, 2), (-1, 1, 51, 2)]
    rows += [(3, 0, 30, 3), (3, 0, 31, 3)] + [(3, 0, 10, 1)] * 5
    df = spark.createDataFrame(rows, "kind int, shapes int, value bigint, context bigint")
    first = {r.context: r.phone for r in pii.pattern_scores(df, rounds=1).collect()}
    assert first == {1: pytest.approx(4 / 6), 2: pytest.approx(3 / 6)}
    trust = 1 - (1 - 4 / 6) * (1 - 3 / 6)
    second = {r.context: r.phone for r in pii.pattern_scores(df, rounds=2).collect()}
    assert second == {1: pytest.approx((4 + trust) / 6), 2: pytest.approx((3 + trust) / 6)}


def test_nulls_repeated_rows_clashing_names_and_an_empty_table(spark):
    long = "x" * 20_000 + " a@b.cd"
    rows = [(None, None, 1), (1, "", 2), (1, "1.2.3.4", 3), (1, "1.2.3.4", 3), (2, long, 4), (3, "é +1 234 567 8901", 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, row int").withColumnRenamed("row", "base")
    got = sorted(((r.doc_id is not None, r.doc_id or 0), [tuple(s) for s in r.base]) for r in pii.personal_data(df).collect())
    assert got == sorted(((i is not None, i or 0), plain(t)) for i, t, _ in rows)
    assert pii.personal_data(df.limit(0)).count() == 0


def test_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = driver.queries()["op12_contextual_pii"](spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        base = plain(docs[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for _, k, _ in base) for kind in range(4)]
        assert r.base_sha256 == hashlib.sha256(line(base).encode()).hexdigest()
        every = r.spans.split(",") if r.spans else []
        assert set(line(base).split(",")) - {""} <= set(every) and len(every) == len(base) + r.n_learned
