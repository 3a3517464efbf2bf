"""Each operator against a brute-force version, and on odd inputs."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerkit.llm import (
    backoff_lm,
    chat_collapse,
    cube_sampling,
    decontaminate,
    importance_resampling,
    language_id,
    packed_ids,
    quotient_filter,
    secret_forest,
    simhash,
)
from layerkit.llm.common import unused
from layerkit.llm.queries import tokenizer_file
from layerkit.llm.words import SPACED, WORDPUNCT, word_hashes

DOCS = "doc_id bigint, text string, lang string, source string, `Words` int, copies string, `a.b` int"


def frame(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 7, "x", 1) for r in rows], DOCS)


def odd_rows():
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma", "delta", "éa", "zeta,", "eta.", "THETA"]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    rows = [
        (1, "Alpha beta gamma delta eta", "en", "a"), (2, "alpha beta gamma delta eta", "en", "a"),
        (3, None, None, None), (4, "", "en", "b"), (5, "  \t\n ", "fr", "b"), (6, "one", "fr", "c"),
        (None, "alpha beta gamma delta eta", "en", None), (None, None, "en", "c"),
        (7, "repeated row", "fr", "a"), (7, "repeated row", "fr", "a"), (8, long, "en", "b"), (9, long + " x", "en", "b"),
        (10, "Á É alpha beta   gamma", "fr", "é"), (11, "12 34 !!", "fr", "Z"),
    ]
    return rows + [
        (100 + i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60))), "en" if i % 3 else "fr", f"s{i % 4}")
        for i in range(60)
    ]


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, odd_rows()).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- exact duplicates

def test_exact_duplicates(odd):
    groups = defaultdict(list)
    for r in odd.collect():
        groups[lowered(r["text"])].append(r["doc_id"])
    want = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        seen = False
        for i in ids:
            kept = i == keep and not seen
            seen = seen or kept
            want[i, keep, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter(map(tuple, quotient_filter.exact_duplicates(odd).collect())) == want


def test_quotient_filters_lose_nothing():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 64, 5000, dtype=np.uint64)
    values = np.concatenate([values, values[:700], values[:20], np.array([0, 0, (1 << 64) - 1], np.uint64)])
    rng.shuffle(values)
    for bits in (0, 3, 9):
        blocks = defaultdict(list)
        for part in np.array_split(values, 7):
            for block, *data in quotient_filter.insert(part, bits):
                blocks[block].append(tuple(data))
        found = {}
        for data in blocks.values():
            found.update(zip(*(x.tolist() for x in quotient_filter.merge(data, bits))))
        assert found == Counter(values.tolist())


def test_equal_fingerprints_of_other_texts_are_told_apart(odd, monkeypatch):
    want = Counter(map(tuple, quotient_filter.exact_duplicates(odd).collect()))
    real = quotient_filter.digests

    def collide(docs, *names):
        return real(docs, *names).withColumn("fingerprint", F.lit(5).cast("bigint"))

    monkeypatch.setattr(quotient_filter, "digests", collide)
    assert Counter(map(tuple, quotient_filter.exact_duplicates(odd).collect())) == want


# ---- SimHash

def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits=2):
    values = sorted(set(prints))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    return {v: find(v) for v in values}


def test_near_duplicates(odd):
    rows = odd.collect()
    prints = [brute_fingerprint(r["text"]) for r in rows]
    comp = brute_components(prints)
    least = {}
    for r, p in zip(rows, prints):
        ids = [i for i in (least.get(comp[p]), r["doc_id"]) if i is not None]
        least[comp[p]] = min(ids, default=None)
    want = Counter((r["doc_id"], f"{p:016x}", least[comp[p]]) for r, p in zip(rows, prints))
    assert Counter(map(tuple, simhash.near_duplicates(odd).collect())) == want


def test_one_document_of_each_component_stays(odd):
    rows, kept = odd.collect(), simhash.keep_one(odd).collect()
    comp = brute_components([brute_fingerprint(r["text"]) for r in rows])
    assert len(kept) == len(set(comp.values()))
    assert {comp[brute_fingerprint(r["text"])] for r in kept} == set(comp.values())
    assert not Counter(kept) - Counter(rows) and kept[0].asDict().keys() == rows[0].asDict().keys()


@pytest.mark.parametrize("scan", [48, 2])
def test_links_connect_what_is_near(spark, monkeypatch, scan):
    """Chains of near values, and long lists that are looked up instead of compared."""
    rng = random.Random(3)
    values = {rng.getrandbits(64) for _ in range(50)}
    for v in list(values)[:10]:
        for _ in range(40):
            values.add(v := v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    base = rng.getrandbits(64)
    values |= {base ^ (k & 0xFF) ^ (k >> 8) << 40 for k in rng.sample(range(1 << 16), 400)}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    nodes = spark.createDataFrame(signed, "fingerprint bigint")
    monkeypatch.setattr(simhash, "_SCAN", scan)
    found = []
    for r in simhash._postings(nodes).collect():
        found.append((r["list"], r["shared"], r["fingerprint"]))
    found.sort()
    lists, shared, prints = (np.array(c) for c in zip(*found))
    a, b = simhash._links(lists, shared, prints.view(np.uint64), 2)
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for x, y in zip(a.tolist(), b.tolist()):
        root[find(x)] = find(y)
    want = brute_components(values)
    assert len({find(v) for v in values}) == len(set(want.values()))
    assert all((find(x) == find(y)) == (want[x] == want[y]) for x in list(values)[::29] for y in list(values)[::17])


def test_components_of_long_chains_and_stars(spark):
    edges = [(i + 1, i) for i in range(200)] + [(1000 + i, 999) for i in range(300)] + [(5, 5)]
    rows = simhash.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    roots = {r["node"]: r["root"] for r in rows}
    assert len(rows) == len(roots) == 502
    assert all(roots[i] == (0 if i <= 200 else 999) for i in roots)


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = (" ".join(random.Random(1).choice(["a", "bb", "Cé"]) for _ in range(3000))).encode()
    want = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "pieces", lambda t: __import__("layerkit.llm.words").llm.words.pieces(t, 64))
    assert simhash.fingerprint(text) == want == brute_fingerprint(text.decode())


# ---- mixing

def test_targets_fill_up_to_their_caps(spark):
    rows = [("a", 100), ("b", 3000), ("c", 10), (None, 50), ("d", 0), ("É", 500)]
    got = {r["source"]: r["target"] for r in cube_sampling.source_targets(
        spark.createDataFrame(rows, "source string, size bigint")).collect()}
    sizes = dict(rows)
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    full, share = set(), 1.5 * sum(sizes.values())
    while True:
        left = share - sum(2 * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        targets = {s: left * weights[s] / sum(weights[o] for o in open_) for s in open_}
        over = {s for s in open_ if targets[s] > 2 * sizes[s]}
        if not over:
            break
        full |= over
    want = {s: targets.get(s, 2.0 * sizes[s]) for s in order}
    assert got == pytest.approx(want)


def test_flight_keeps_totals():
    rng = random.Random(2)
    sizes = [rng.randint(0, 900) for _ in range(999)]
    chances = [rng.random() for _ in sizes]
    flown = cube_sampling.flight(chances, sizes, random.Random(1))
    assert sum(0 < p < 1 for p in flown) <= 2
    assert sum(flown) == pytest.approx(sum(chances))
    assert sum(p * s for p, s in zip(flown, sizes)) == pytest.approx(sum(p * s for p, s in zip(chances, sizes)))


# a document of a ninth of all words takes the place of up to a hundred others
@pytest.mark.parametrize("largest, documents_off", [(900, 3), (50_000, 111)])
def test_landing_decides_all_and_ends_with_small_documents(largest, documents_off):
    rng = random.Random(2)
    sizes = [rng.randint(1, 900) for _ in range(999)] + [largest, 0, 0]
    for seed in range(5):
        chances = [rng.random() for _ in sizes]
        landed = cube_sampling.landing(chances, sizes, random.Random(seed))
        assert set(landed) <= {0.0, 1.0}
        assert abs(sum(landed) - sum(chances)) < documents_off
        assert abs(sum((p - c) * s for p, c, s in zip(landed, chances, sizes))) < sorted(sizes)[20]
    assert cube_sampling.landing([0.0, 1.0], [3, 4], rng) == [0.0, 1.0] and cube_sampling.landing([], [], rng) == []


@pytest.mark.parametrize("sizes", [[1, 5, 5, 2, 0, 9, 4], [7], [0, 0, 0, 0], [30, 0, 0], [3, 3, 3, 3, 3], [8, 2]])
@pytest.mark.parametrize("chance", [0.3, 0.5])
def test_landing_keeps_chances(sizes, chance):
    drawn = [cube_sampling.landing([chance] * len(sizes), sizes, random.Random(i)) for i in range(3000)]
    assert abs(np.mean(drawn, axis=0) - chance).max() < 0.04


def test_sources_come_within_their_median_document(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = cube_sampling.mix(docs.withColumn("source", (F.col("doc_id") % 2).cast("string"))).toPandas()
    sources = rows.groupby(["source_size", "target"])
    assert len(sources) == 2
    for _, own in sources:
        assert abs(own["taken"].sum() - own["target"].iloc[0]) <= own["size"].median()


def test_mix(odd):
    rows, got = odd.collect(), cube_sampling.mix(odd).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r["doc_id"], size(r["text"])) for r in rows)
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    by = defaultdict(list)
    for r in got:
        by[r["source_size"], r["target"]].append(r)
    for (source_size, target), own in by.items():
        alike = sum(r["size"] for r in own) / max(source_size, 1)  # sources of that size
        assert abs(sum(r["taken"] for r in own) - alike * target) <= max(r["size"] for r in own)
    again = cube_sampling.mix(odd.repartition(5)).collect()
    assert Counter(got) == Counter(again)


def test_many_blocks_stay_balanced(spark):
    rng = random.Random(4)
    units = spark.createDataFrame(
        [(i, "s" if i % 3 else None, rng.randint(1, 400), 0.37) for i in range(3000)],
        "id bigint, source string, size bigint, chance double",
    )
    got = cube_sampling.draw(units, ["id"], block=64).collect()
    assert len(got) == 3000 and {r["chance"] for r in got} == {0.0, 1.0}
    for source in ("s", None):
        own = [r for r in got if r["source"] == source]
        assert abs(sum(r["size"] * (r["chance"] - 0.37) for r in own)) <= 400
        assert abs(sum(r["chance"] - 0.37 for r in own)) < 4


def test_mixed_documents_are_the_mix(odd):
    want = Counter()
    for r in cube_sampling.mix(odd).collect():
        want[r["doc_id"]] += r["copies"]
    got = cube_sampling.mixed_documents(odd)
    assert got.columns == odd.columns
    total = Counter(r["doc_id"] for r in got.collect())
    assert sum(total.values()) == pytest.approx(sum(want.values()), abs=6)
    assert set(got.collect()) <= set(odd.collect())


# ---- token ids

@given(st.integers(1, 32), st.lists(st.integers(0, (1 << 32) - 1), max_size=300))
@settings(max_examples=60, deadline=None)
def test_packing_round_trip(bits, ids):
    ids = np.array([i & (1 << bits) - 1 for i in ids], np.uint32)
    data = packed_ids.pack(ids, bits)
    assert len(data) == -(-len(ids) * bits // 8)
    assert (packed_ids.unpack(data, len(ids), bits) == ids).all()


TRICKY = ["it's we'LL x <|endoftext|> <|ENDOFTEXT|>. áb İΣς ﬁ ‍ \x1c q", "é ́x J̌a, J̌. é… …. a…, x<|endoftext|>.,",
          "Ab!'s don't, (it'S) a'. b''s.) 1a2. A1! ##x## e-mail, ≮ a̸, ≠", "中文。 字,字 ½. ²a"]


@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aAbé'.,!<|> \ń̸1")), max_size=60), max_size=6))
@settings(max_examples=300, deadline=None)
def test_words_encode_like_whole_texts(texts):
    tokenizer = packed_ids._tokenizer(tokenizer_file())
    texts = texts + TRICKY
    ids, counts = packed_ids._encoder(tokenizer_file()).encode([t.encode() for t in texts])
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert np.split(ids, np.cumsum(counts)[:-1])[0].tolist() == want[0]
    assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]


def test_token_files(spark, odd, tmp_path, monkeypatch):
    tokenizer = packed_ids._tokenizer(tokenizer_file())
    manifest = packed_ids.write_files(odd.repartition(4), tokenizer_file(), f"file://{tmp_path}/ids")
    got = sorted(packed_ids.read_files(manifest).collect(), key=lambda r: r["start"])
    rows = odd.collect()
    ids = {r["text"]: [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in rows}
    assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in rows), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    crc = lambda t: zlib.crc32(np.array(ids[t], "<u4").tobytes())
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter(
        (r["doc_id"], len(ids[r["text"]]), crc(r["text"])) for r in rows
    )


def test_any_token_is_found_in_a_file(monkeypatch):
    monkeypatch.setattr(packed_ids, "BLOCK", 128)
    rng = np.random.default_rng(3)
    sink = pa.BufferOutputStream()
    writer = packed_ids.Writer(sink, 17)
    lengths = rng.integers(1, 90, 40)
    ids = rng.integers(0, 1 << 17, lengths.sum()).astype(np.uint32)
    for part in np.split(np.arange(40), 4):
        first, last = lengths[: part[0]].sum(), lengths[: part[-1] + 1].sum()
        writer.add(part, part < 0, lengths[part], ids[first:last])
    writer.close()
    reader = packed_ids.Reader(pa.BufferReader(sink.getvalue()))
    assert reader.n_ids == len(ids) and reader.docs.tolist() == list(range(40))
    for a, b in ((0, 1), (127, 129), (5, 700), (len(ids) - 1, len(ids)), (9, 9)):
        assert reader.ids(a, b).tolist() == ids[a:b].tolist()
    assert [n for n, _ in reader.documents()] == lengths.tolist()


# ---- decontamination

def bench_frame(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def brute_contamination(docs, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add("" if item is None else str(item))
    out = Counter()
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[i : i + n]))) is not None:
                    found |= own
                    hit.update(range(i, i + n))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)] += 1
    return out


@pytest.fixture(scope="module")
def contaminated(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(40)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.choice([1, 5, 13, 20, 45]))) for i in range(12)] + [(50, None), (None, text(14)), (51, "..."), (3, text(15))]
    docs = [(400 + i, text(rng.randint(0, 80))) for i in range(30)] + odd_texts()
    docs += [(200 + i, text(rng.randint(0, 30)) + " - " + (t or "").upper() + "!" + text(400 * (i % 2))) for i, (_, t) in enumerate(items)]
    return docs, items


def odd_texts():
    return [(r[0], r[1]) for r in odd_rows()[:14]]


@pytest.mark.parametrize("broadcast", [1 << 20, -1])
def test_contamination(spark, contaminated, broadcast):
    docs, items = contaminated
    frame_ = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = decontaminate.contamination(frame_, bench_frame(spark, items), broadcast_bytes=broadcast)
    assert Counter(map(tuple, got.collect())) == brute_contamination(docs, items)
    assert not any(n in got._jdf.queryExecution().toString() for n in ("Python", "Arrow", "Pandas"))


def test_windows_too_large_to_broadcast_move_no_whole_text(spark, contaminated, explained):
    docs, items = contaminated
    frame_ = spark.createDataFrame(docs, "doc_id bigint, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = decontaminate.contamination(frame_, bench_frame(spark, items), broadcast_bytes=-1)
        plan = explained(got)
        assert Counter(map(tuple, got.collect())) == brute_contamination(docs, items)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: (.*)", plan)
    assert len(moved) >= 3 and any("ahead#" in m for m in moved)
    assert not any("words#" in m.replace("n_words#", "") for m in moved)


def test_clean_documents_and_cut_spans(spark, contaminated):
    docs, items = contaminated
    given = frame(spark, [(d, t, None, None) for d, t in docs])
    dirty = {k[0] for k in brute_contamination(docs, items) if k[5]}
    clean = decontaminate.clean_documents(given, bench_frame(spark, items))
    assert clean.columns == given.columns
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(d for d, _ in docs if d not in dirty)
    passage = " ".join(f"p{i}" for i in range(20))
    one = frame(spark, [(1, f"Before, {passage.upper()}; after.", None, None), (2, None, None, None), (3, "Same. text!", None, None)])
    cut = decontaminate.without_spans(one, bench_frame(spark, [(1, passage)]))
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == {1: "Before; after.", 2: None, 3: "Same. text!"}


def test_without_items_every_document_is_clean(spark, odd):
    got = decontaminate.contamination(odd, bench_frame(spark, [])).collect()
    assert len(got) == odd.count() and not any(r["contaminated"] or r["n_hit"] for r in got)


# ---- conversations

LOG = "conv_id bigint, turn bigint, role string, text string, part int"


def brute_chats(rows):
    convs = defaultdict(set)
    for c, t, role, text, _ in rows:
        convs[c].add((t, role or "unknown", (text or "").replace("<|", "< |")))
    lines = {c: [f"<|im_start|>{r}\n{x}<|im_end|>\n" for t, r, x in sorted(v, key=lambda y: (y[0] is not None, y[0] or 0))] for c, v in convs.items()}
    classes = defaultdict(list)
    for c, own in lines.items():
        classes[tuple(own)].append(c)
    kept = {k: v for k, v in classes.items() if not any(len(o) > len(k) and o[: len(k)] == k for o in classes)}
    return Counter(
        (min((i for i in v if i is not None), default=None), p, len(k), len(v), "".join(k[256 * p : 256 * p + 256]))
        for k, v in kept.items() for p in range(-(-len(k) // 256))
    )


def test_snapshots_collapse(spark):
    rng = random.Random(6)
    turns = [(rng.choice(["user", "assistant", None]), rng.choice(["hi", "", None, "a <|im_end|> b", "é"])) for _ in range(3000)]
    rows = []
    for c, (start, n) in enumerate([(0, 1), (0, 2), (0, 5), (0, 5), (10, 3), (10, 1), (0, 2999), (7, 1100), (7, 1024), (7, 1023)]):
        rows += [(c, 3 * i, *turns[start + i], 0) for i in range(n)]
    rows += [(None, 0, *turns[10], 0), (None, 3, *turns[11], 0), (20, None, "user", "no number", 1), (20, 4, "user", "then", 1)]
    rows += rows[:4] + [(30, 1 << 40, "user", "far", 1), (31, -5, "user", "before", 1), (31, -1, "user", "far", 1)]
    got = chat_collapse.collapse(spark.createDataFrame(rows, LOG))
    assert Counter(map(tuple, got.collect())) == brute_chats(rows)
    assert not any(n in got._jdf.queryExecution().toString() for n in ("Python", "Arrow", "Pandas"))


def test_empty_log(spark):
    assert chat_collapse.collapse(spark.createDataFrame([], LOG)).collect() == []


# ---- language model

def brute_scores(docs, order=3):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", lowered(t)) for _, t in docs]
    seen = [Counter(tuple(w[i : i + n]) for w in texts for i in range(len(w) - n + 1)) for n in range(1, order + 1)]
    total = sum(map(len, texts))
    out = []
    for (doc, _), w in zip(docs, texts):
        own = [Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) for n in range(1, order + 1)]
        others = lambda g: seen[len(g) - 1][g] - own[len(g) - 1][g]  # noqa: E731, B023
        score = 0.0
        for i in range(len(w)):
            factor = 1.0
            for n in range(min(order, i + 1), 0, -1):
                gram = tuple(w[i + 1 - n : i + 1])
                if n == 1:
                    score += np.log(factor * max(others(gram), 0.5) / max(total - len(w), 1))
                elif others(gram):
                    score += np.log(factor * others(gram) / others(gram[:-1]))
                    break
                factor *= 0.4
        out.append((doc, len(w), round(score, 6), round(score / len(w), 6) if w else None))
    return Counter(out)


@pytest.mark.parametrize("order", [1, 3])
def test_backoff_scores(spark, odd, order, monkeypatch):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = backoff_lm.score(odd, order=order).collect()
    rounded = Counter((r[0], r[1], round(r[2], 6), None if r[3] is None else round(r[3], 6)) for r in got)
    assert rounded == brute_scores(docs, order)


def test_chunks_of_any_size_score_the_same(odd, monkeypatch):
    want = Counter((r[0], r[1], round(r[2], 6)) for r in backoff_lm.score(odd).collect())
    gathered = backoff_lm.chunks
    monkeypatch.setattr(backoff_lm, "chunks", lambda docs: gathered(docs, 300))
    assert Counter((r[0], r[1], round(r[2], 6)) for r in backoff_lm.score(odd.repartition(3)).collect()) == want


def test_counts_come_back_through_several_levels(spark, odd, monkeypatch):
    want = Counter((r[0], r[1], round(r[2], 6)) for r in backoff_lm.score(odd).collect())
    gathered, cut = backoff_lm.chunks, backoff_lm._answers
    levels = []

    def answers(asked, chunks, fan, parts, partitions):
        levels.append((fan, parts, partitions))
        return cut(asked, chunks, fan, parts, partitions)

    monkeypatch.setattr(backoff_lm, "chunks", lambda docs: gathered(docs, 300))
    monkeypatch.setattr(backoff_lm, "CHUNK", 300)
    monkeypatch.setattr(backoff_lm, "FAN", 2)
    monkeypatch.setattr(backoff_lm, "_answers", answers)
    got = backoff_lm.score(odd.repartition(3)).collect()
    assert Counter((r[0], r[1], round(r[2], 6)) for r in got) == want
    assert [parts for _, parts, _ in levels] == [2, 4, 8] and {p for *_, p in levels} == {8}


def test_every_task_counts_the_same_number_of_ranges(odd):
    plan = backoff_lm.score(odd)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("REPARTITION_BY_NUM"), plan


# ---- quality

def test_resampling_prefers_what_looks_like_the_target(spark):
    rng = random.Random(9)
    good, bad = [f"g{i}" for i in range(30)], [f"b{i}$$$" for i in range(30)]
    rows = [(i, " ".join(rng.choice(good if i % 2 else bad) for _ in range(80)), None, None) for i in range(200)]
    docs = frame(spark, rows + [(500, None, None, None), (None, "g1 g2", None, None)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(1, 1, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = importance_resampling.resample(docs, labels, share=0.5).collect()
    assert len(got) == 202 and sum(r["kept"] for r in got) == 101
    assert sum(r["kept"] for r in got if r["doc_id"] and r["doc_id"] < 200 and r["doc_id"] % 2) >= 99
    again = importance_resampling.resample(docs.repartition(3), labels, share=0.5).collect()
    assert Counter((r["doc_id"], r["kept"]) for r in got) == Counter((r["doc_id"], r["kept"]) for r in again)
    keys = sorted((r["key"] for r in got), reverse=True)
    assert all(r["kept"] == (r["key"] >= keys[100]) for r in got)


def test_weights_are_log_ratios_of_counted_grams(spark):
    docs = frame(spark, [(1, "a b a", None, None), (2, "c, b", None, None)])
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    got = {r["doc_id"]: r for r in importance_resampling.resample(docs, labels).collect()}
    assert (got[1]["n_grams"], got[2]["n_grams"]) == (5, 5)
    size = importance_resampling.BUCKETS
    part = lambda target, raw: np.log((target + 1) / (5 + size)) - np.log((raw + 1) / (10 + size))
    assert got[2]["log_weight"] == pytest.approx(4 * part(0, 1) + part(1, 2))
    assert got[1]["log_weight"] == pytest.approx(2 * part(2, 2) + part(1, 2) + 2 * part(1, 1))


def test_long_texts_keep_their_whole_ratio(spark):
    docs = frame(spark, [(1, "a " * 300, None, None), (2, "b " * 300, None, None)])
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    size = importance_resampling.BUCKETS
    part = lambda target, raw: np.log((target + 1) / (599 + size)) - np.log((raw + 1) / (1198 + size))
    want = 300 * part(300, 300) + 299 * part(299, 299)
    for reference, scale in ((None, 1), (128, 128 / 599)):
        got = {r["doc_id"]: r for r in importance_resampling.resample(docs, labels, reference=reference).collect()}
        assert got[1]["n_grams"] == 599 and got[1]["log_weight"] == pytest.approx(want * scale)


# ---- languages

def test_languages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language_id.train(docs)
    got = {r["doc_id"]: r for r in language_id.predict(docs, model).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    assert all(got[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    apart = [r for r in rows if got[r["doc_id"]]["held_out"] and r["lang"]]
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in apart]) >= 0.95
    again = language_id.train(docs.repartition(5))
    assert (again.weights == model.weights).all() and again.threshold == model.threshold


def test_texts_without_letters_are_undetermined(spark, odd):
    model = language_id.train(odd)
    assert model.languages == ["en", "fr"]
    got = language_id.predict(odd, model).collect()
    letters = lambda t: any(c.isalpha() for c in t or "")
    want = Counter((r["doc_id"], letters(r["text"])) for r in odd.collect())
    assert Counter((r["doc_id"], r["lang_pred"] != "und") for r in got) == want
    assert all(0 <= r["score"] <= 1 and (r["lang_pred"] != "und" or (r["rejected"] and r["score"] == 0)) for r in got)
    kept = language_id.accepted(odd, model)
    assert kept.columns == odd.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in got if not r["rejected"])
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert language_id.train(unlabelled) is None
    assert {r["lang_pred"] for r in language_id.predict(odd, None).collect()} == {"und"}


def test_long_texts_have_the_subwords_of_their_parts(monkeypatch):
    text = b"abc De1f " * 4000
    whole = Counter(np.concatenate([h for _, h in language_id.subwords([text])]).tolist())
    monkeypatch.setattr(language_id, "_PIECE", 1000)
    assert Counter(np.concatenate([h for _, h in language_id.subwords([text])]).tolist()) == whole


def test_unlearnt_languages_are_rejected(spark, sf):
    """One language left out of training at a time, and languages that are nowhere in the tables."""
    docs = spark.read.parquet(f"{os.path.dirname(sf)}/sf0.01/documents.parquet").where("length(text) >= 40").cache()
    for left_out in ("de", "es", "fr", "en"):
        model = language_id.train(docs.where(F.col("lang") != left_out))
        got = language_id.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
        shares = {r[0]: r[1] for r in got.groupBy(F.col("lang") == left_out).agg(F.avg(F.col("rejected").cast("int"))).collect()}
        assert shares[True] >= 0.9 and shares[False] <= 0.02, (left_out, shares)
    model = language_id.train(docs)
    assert model.temperature >= 1
    strange = ["Tämä on suomenkielinen lause jota kukaan ei ymmärrä", "Dit is een Nederlandse zin over het weer vandaag",
               "asdf jkl asdf jkl qwe rtz", "Это русский текст о погоде и о людях", "qzx vkw jjqp xxzq", "これは日本語の文章です。"]
    got = language_id.predict(frame(spark, [(i, t, None, "s") for i, t in enumerate(strange)]), model).collect()
    assert all(r["rejected"] and r["lang_pred"] != "und" for r in got)
    assert language_id.predict(docs, model).where("rejected").count() <= 0.02 * docs.count()
    # only the most frequent languages are learnt when there are too many
    many = frame(spark, [(i, f"text of {i % 300}", f"l{i % 300:03d}", "s") for i in range(1500)])
    assert len(language_id.train(many, per_language=2).languages) == language_id.LANGUAGES


# ---- secrets

def test_secrets(spark):
    rng = random.Random(11)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    word = lambda: "".join(rng.choice(["tion", "ing", "the", "and"]) for _ in range(6))
    rows = [(i, f'the and ing tion\ntoken = "{key()}" the {word()} and {rng.randrange(10**15, 10**16)}', "en", "src") for i in range(80)]
    rows += [(200, f"commit {key()} the", "en", "tests/x"), (201, None, None, None), (202, "", "en", None), (None, f'"{key()}"', "en", "a"), (7, rows[7][1], "en", "src")]
    rows += [(300 + i, f"commit {key()} the", "en", "tests/x") for i in range(30)]
    got = secret_forest.findings(frame(spark, rows)).collect()
    pattern = re.compile(r"(?<![A-Za-z0-9+/_=\-])[A-Za-z0-9+/_=\-]{16,}")
    want = Counter((d, k, hashlib.sha256(m.encode()).hexdigest()) for d, t, *_ in rows for k, m in enumerate(pattern.findall(t or "")))
    assert Counter((r["doc_id"], r["ordinal"], r["candidate_sha256"]) for r in got) == want
    named = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 100]
    assert all(r["is_secret"] == (r["n_chars"] == 40 and r["ordinal"] == 0) for r in named)
    assert not any(r["is_secret"] for r in got if r["doc_id"] and r["doc_id"] >= 200)


def test_own_features_by_hand(spark):
    rng = random.Random(4)
    values = ["".join(rng.choice("abgzAGZ09_-/+=") for _ in range(rng.randint(4, 20))) for _ in range(300)] + ["myToken12", "aAaAaA", "x" * 3000]
    got = secret_forest.own_features(spark.createDataFrame([(v,) for v in values], "candidate string"), ["abg", "abga"])
    for r in got.collect():
        v, n = r["candidate"], len(r["candidate"])
        kind = ["0" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else "-" for c in v]
        pairs = list(zip(kind, kind[1:]))
        want = {
            "digits": kind.count("0"), "lowers": kind.count("a"), "uppers": kind.count("A"), "marks": kind.count("-"),
            "hexes": sum(c in "0123456789abcdefABCDEF" for c in v), "letter_digit": sum(a in "aA" and b == "0" for a, b in pairs),
            "digit_letter": sum(a == "0" and b in "aA" for a, b in pairs), "case_changes": sum({a, b} == {"a", "A"} for a, b in pairs),
            "distinct_chars": len(set(v)), "covered": n - len(re.sub("abga|abg", "", v.lower())), "credential_inside": n * ("token" in v.lower()),
        }
        assert r["n_chars"] == n and all(r[f] == pytest.approx(x / n) for f, x in want.items()), (v, want)


def test_candidates_of_every_form_keep_their_context(spark):
    key = "abcdEFGH1234abcdEFGH1234ab=="
    texts = {
        'password = "hunter2x9"': "hunter2x9", "API_KEY=sk_live_abcdEFGH1234 x": "sk_live_abcdEFGH1234",
        f'aws_secret_access_key = "{key}"': key, "https://x.y/?page=2&pin=1234&lang=en": "1234", "a=b, password: qwertzui.": "qwertzui",
    }
    found = secret_forest.candidates(frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]))
    got = {(r["doc_id"], r["candidate"]): r for r in secret_forest.with_features(found, []).collect()}
    for i, (text, value) in enumerate(texts.items()):
        row, place = got[i, value], text.index(value)
        assert (row["before"], row["after"]) == (text[max(0, place - 48) : place], text[place + len(value) :][:48])
        assert row["assigned"] == 1 and (row["credential_before"] == 1 or value == "1234")


def test_context_is_the_text_around(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(["=", ":", " ", '"', "é", "ab", "Ab1_-", "xyz/9+", "=="]) for _ in range(400)) for _ in range(30)]
    got = secret_forest.candidates(frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])).collect()
    assert len(got) > 300
    for i, text in enumerate(texts):
        end = 0
        for r in sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["ordinal"]):
            places = [m for m in range(end, len(text)) if text.startswith(r["candidate"], m)]
            place = next(m for m in places if text[max(0, m - 48) : m] == r["before"])
            end = place + len(r["candidate"])
            assert text[end : end + 48] == r["after"]


def test_given_labels_decide(spark):
    rows = [(i, f"x {'ab1' * (6 + i % 5)} y {'q' * 20} z", "en", "p") for i in range(40)]
    labels = spark.createDataFrame([(i, k, 1 - k) for i in range(40) for k in (0, 1)], "doc_id bigint, ordinal bigint, label int")
    got = secret_forest.findings(frame(spark, rows), labels=labels).collect()
    assert all(r["is_secret"] == (r["ordinal"] == 0) for r in got) and len(got) == 80
    only = secret_forest.findings(frame(spark, rows), labels=labels.where("label = 0")).collect()
    assert len(only) == 80 and not any(r["is_secret"] for r in only)
    assert all(r["score"] is None and r["is_secret"] is None for r in only)


def test_secrets_of_several_forms_without_labels(spark):
    rng = random.Random(17)
    values = ["".join(rng.choice(a) for _ in range(n)) for a, n in (("abcdefgh", 12), ("0123456789", 9), ("abc012XYZ", 30), ("0a1b2c3d", 40))]
    forms = ['smtp_password = "{}"', "STRIPE_API_KEY={}", "https://h.x/p?a=1&access_token={}&z=2", "google_client_secret_key: '{}'"]
    texts = [(f"the note of the day and {f.format(v)} and then", v) for f in forms for v in (*values, "hunter2x9")]
    texts += [(f"see the commit {values[3]} of the fix", None), (f"see the {values[0]} of it", None), (f"call {values[1]} now", None)]
    got = secret_forest.findings(frame(spark, [(i, t, "en", "s") for i, (t, _) in enumerate(texts)])).collect()
    found = {(r["doc_id"], r["candidate_sha256"]) for r in got if r["is_secret"]}
    assert found == {(i, hashlib.sha256(v.encode()).hexdigest()) for i, (_, v) in enumerate(texts) if v}


# ---- all

def test_empty_tables_give_no_rows(spark, empty):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quotient_filter.exact_duplicates(empty).collect() == []
    assert simhash.near_duplicates(empty).collect() == simhash.keep_one(empty).collect() == []
    assert cube_sampling.mix(empty).collect() == cube_sampling.mixed_documents(empty).collect() == []
    assert packed_ids.token_files(empty, tokenizer_file()).collect() == []
    assert decontaminate.contamination(empty, bench_frame(spark, [(1, "a b")])).collect() == []
    assert backoff_lm.score(empty).collect() == []
    assert importance_resampling.resample(empty, labels).collect() == []
    assert language_id.predict(empty, language_id.train(empty)).collect() == []
    assert secret_forest.findings(empty).collect() == []


def test_word_hashes():
    texts = [b"a bb  ccc\n", b"", b"   ", b"bb ccc a", b"x" * 10]
    hashes, counts = word_hashes(texts, SPACED)
    assert counts.tolist() == [3, 0, 0, 3, 1] and len(set(hashes.tolist())) == 4
    hashes, counts = word_hashes([b"a,b!! !!"], WORDPUNCT)
    assert counts.tolist() == [5] and hashes[3] == hashes[4]


def test_unused_names():
    assert unused(["A", "a_"], "a", "b") == ["a__", "b"]
