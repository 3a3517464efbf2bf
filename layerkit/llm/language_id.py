"""Language identification by averaged hashed subword embeddings.

The subwords of a text are all runs of two to four bytes within its words, the word's edges
included. Each hashes to an embedding; a text is the average of its embeddings, and a linear softmax
over it gives the languages. Embeddings and softmax are trained together by stochastic gradient
descent in numpy, on a bounded sample of labelled texts. A temperature, fitted on texts left out of
training, calibrates the scores.

A softmax is sure of one of its languages whatever it is given, so what decides on rejection is how
familiar a text is: the mean log probability of its subwords among those of the language it was
given. The bound of a language lies between its own texts left out of training and the other languages'
texts, seen as if they were of this one: those stand for languages never learnt.

Training needs the model's driver to hold the sample's subword counts only; prediction needs
nothing but the product of embeddings and softmax, one row of numbers per hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerkit.llm.common import column, text_slices

BUCKETS = 1 << 15
LENGTHS = (2, 3, 4)
DIMENSIONS = 16
#: The most texts of a language the model is trained on.
PER_LANGUAGE = 500
#: The most languages learnt, the most frequent ones, and the most texts of all of them together.
LANGUAGES, TEXTS = 256, 10_000
#: How far the bound lies from a language's own texts to the others', the least it keeps from its own ones (in nats),
#: and what it keeps where there are no others.
BETWEEN, LEAST_GAP, ALONE_GAP = 0.75, 1.0, 2.5
#: Subwords overlap; so many tell as much as one that stands alone.
_OVERLAP = 9
EPOCHS = 12
UNKNOWN = "und"
_PIECE = 1 << 20


def _letters() -> np.ndarray:
    """Lower-case ASCII letters and all other UTF-8 bytes stand for themselves, A-Z for a-z, the
    rest for an edge."""
    table = np.zeros(256, np.uint32)
    table[0x80:] = np.arange(0x80, 0x100)
    table[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
    table[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
    return table


_LETTERS = _letters()


def _cut(text: bytes) -> Iterator[bytes]:
    """Parts of a long text, cut at an ASCII byte that is no letter if there is one."""
    start = 0
    while len(text) - start > _PIECE:
        window = np.frombuffer(text, np.uint8, min(_PIECE, len(text) - start - _PIECE), start + _PIECE)
        edge = np.flatnonzero(_LETTERS[window] == 0)
        end = start + _PIECE + (int(edge[0]) if len(edge) else len(window))
        yield text[start:end]
        start = end
    yield text[start:]


def subwords(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of texts, hashes) of all subwords, a bounded number of texts at a time."""
    run: list[bytes] = []
    owner: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        for part in _cut(text):
            if size + len(part) > _PIECE and run:
                yield from _subwords(run, owner)
                run, owner, size = [], [], 0
            run.append(part)
            owner.append(i)
            size += len(part) + 1
    if run:
        yield from _subwords(run, owner)


def _subwords(run: list[bytes], owner: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    codes = _LETTERS[np.frombuffer(b" " + b" ".join(run) + b" ", np.uint8)]
    starts = np.cumsum([0] + [len(p) + 1 for p in run[:-1]])
    # the edge before a text belongs to it
    texts = np.repeat(np.array(owner), np.diff(np.append(starts, len(codes))))
    inner = codes != 0
    for n in LENGTHS:
        count = len(codes) - n + 1
        if count <= 0:
            continue
        whole = inner[:count] | inner[n - 1 : n - 1 + count] if n == 2 else np.ones(count, bool)
        for k in range(1, n - 1):
            whole &= inner[k : k + count]
        at = np.flatnonzero(whole)
        h = np.full(len(at), n, np.uint32)
        for k in range(n):
            h = (h ^ codes[at + k]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
        yield texts[at], (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - 15)


@dataclass
class Model:
    """Languages, a row of weights per hash, bias, temperature and the score to reject below; log
    probabilities of the hashes in each language, the bounds of their mean, and their spread."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float
    familiar: np.ndarray
    bounds: np.ndarray
    spread: np.ndarray

    def judged(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated probability of each language for each text, and whether the text is too strange to
        be of the likeliest one. Of equally likely languages the first in order is taken."""
        k = len(self.languages)
        table = np.hstack([self.weights, self.familiar])
        total = np.zeros((len(texts), 2 * k))
        counts = np.zeros(len(texts))
        for owner, hashes in subwords(texts):
            if len(owner):
                first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
                total[owner[first]] += np.add.reduceat(table[hashes], first, axis=0)
                counts[owner[first]] += np.diff(np.append(first, len(owner)))
        mean = total / np.maximum(counts, 1)[:, None]
        p = self._softmax(mean[:, :k] + self.bias)
        best = p.argmax(axis=1)
        # short texts may be stranger
        slack = self.spread[best] / np.sqrt(np.maximum(counts, 1) / _OVERLAP)
        return p, mean[np.arange(len(texts)), k + best] < self.bounds[best] - slack

    def _softmax(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def _descend(samples: list[tuple], labels: np.ndarray, n_languages: int, epochs: int) -> tuple[np.ndarray, ...]:
    """Stochastic gradient descent over one text at a time; the step shrinks to zero."""
    rng = np.random.default_rng(0)
    embeddings = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    softmax = np.zeros((DIMENSIONS, n_languages))
    bias = np.zeros(n_languages)
    steps, done = epochs * len(samples), 0
    for _ in range(epochs):
        for i in rng.permutation(len(samples)):
            hashes, share = samples[i]
            rate = 1.0 * (1 - done / steps)
            done += 1
            x = share @ embeddings[hashes]
            z = x @ softmax + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = softmax @ p
            softmax -= rate * np.outer(x, p)
            bias -= rate * 0.1 * p
            # the average passes its gradient on by share; scaled up as few hashes move a lot
            embeddings[hashes] -= rate * 10 * share[:, None] * back
    return embeddings, softmax, bias


def _calibrated(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss on texts not trained on."""
    best, least = 1.0, np.inf
    for t in np.exp(np.linspace(np.log(0.02), np.log(20), 80)):
        z = logits / t
        z -= z.max(axis=1, keepdims=True)
        loss = -(z[np.arange(len(z)), labels] - np.log(np.exp(z).sum(axis=1))).mean()
        if loss < least - 1e-9:
            best, least = float(t), loss
    return best


def fit(samples: list[tuple[str, np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> Model:
    """Model from (language, hashes, counts) of each text. Every fifth text calibrates."""
    languages = sorted({s[0] for s in samples})
    labels = np.array([languages.index(s[0]) for s in samples], np.int64)
    shares = [(h.astype(np.int64), c / max(1, c.sum())) for _, h, c in samples]
    apart = np.arange(len(samples)) % 5 == 4
    train = np.flatnonzero(~apart)
    embeddings, softmax, bias = _descend([shares[i] for i in train], labels[train], max(1, len(languages)), epochs)
    weights = embeddings @ softmax
    familiar, spread = _familiar([samples[i][1:] for i in train], labels[train], max(1, len(languages)))
    bounds = np.full(len(spread), -np.inf)
    model = Model(languages, weights.astype(np.float32), bias, 1.0, 0.0, familiar.astype(np.float32), bounds, spread)
    test = np.flatnonzero(apart)
    if not len(test):
        return model
    own = np.array([s @ familiar[h] for h, s in (shares[i] for i in test)])
    for k in range(len(languages)):
        mine, others = own[labels[test] == k, k], own[labels[test] != k, k]
        if len(mine):
            low = np.quantile(mine, 0.02)
            gap = BETWEEN * (low - np.quantile(others, 0.98)) if len(others) else ALONE_GAP
            bounds[k] = low - max(LEAST_GAP, gap)
    if len(languages) > 1:
        logits = np.array([s @ weights[h] + bias for h, s in (shares[i] for i in test)])
        right = logits.argmax(axis=1) == labels[test]
        # without a mistake to learn from, no score is to be raised
        model.temperature = max(_calibrated(logits, labels[test]), 1.0 if right.all() else 0.0)
        p = model._softmax(logits)
        # texts of two languages score about a half and are not to go
        least = (1 / len(languages) + 0.5) / 2
        model.threshold = float(min(least, p.max(axis=1)[right].min(initial=least)))
    return model


def _familiar(texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_languages: int) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of each hash in each language, and how far it spreads over its subwords."""
    seen = np.full((n_languages, BUCKETS), 0.5)
    for (hashes, counts), k in zip(texts, labels):
        seen[k, hashes] += counts
    p = seen / seen.sum(axis=1, keepdims=True)
    log = np.log(p)
    mean = (p * log).sum(axis=1, keepdims=True)
    return np.ascontiguousarray(log.T), np.sqrt((p * (log - mean) ** 2).sum(axis=1))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept for testing: crc32 of its id as text, modulo 4, is 2. A null id
    is neither learnt from nor held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Model | None:
    """Model of the languages in `lang`, learnt from texts and languages of at most
    `per_language` documents of each language that are not held out; None if there are none. At most `LANGUAGES`
    are learnt, the most frequent ones, of equally frequent ones the first; texts of the rest are strange to the
    model. The sample goes by hashes of id and text, so a rerun learns the same. The driver gets
    the counts of at most `BUCKETS` hashes for each of at most `TEXTS` documents."""
    key, value, name = column(docs, doc_id), column(docs, text), column(docs, lang)
    usable = docs.where(key.isNotNull() & ~held_out(key) & name.isNotNull() & value.isNotNull())
    sizes = usable.groupBy(name.alias("lang")).agg(F.count("*").alias("n"))
    counts = {r[0]: r[1] for r in sizes.orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()}
    if not counts:
        return None
    per_language = max(1, min(per_language, TEXTS // len(counts)))
    # thinned out by hash first, to a few times the bound, then cut to it in each language
    chance = F.lit(0.0)
    for language, n in counts.items():
        chance = F.when(name == F.lit(language), F.lit(min(1.0, 4 * per_language / n))).otherwise(chance)
    mark = F.xxhash64(F.lit(2), key, value)
    some = usable.where(F.pmod(mark, F.lit(1 << 20)) < chance * (1 << 20)).select(
        name.alias("lang"), mark.alias("mark"), value.alias("text")
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("mark", "text"))
    some = some.withColumn("rank", rank).where(F.col("rank") <= per_language)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, run in text_slices(batch.column(1)):
                rows = []
                for t in run:
                    found = [h for _, h in subwords([t])]
                    hashes, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint32), return_counts=True)
                    rows.append((hashes.astype(np.uint16).tobytes(), n.astype(np.uint32).tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(run)), batch.column(2).slice(start, len(run)),
                        pa.array([h for h, _ in rows], pa.binary()), pa.array([n for _, n in rows], pa.binary()),
                    ],
                    names=["lang", "mark", "hashes", "counts"],
                )

    found = some.select("lang", "text", "mark").mapInArrow(
        features, "lang string, mark bigint, hashes binary, counts binary"
    )
    rows = sorted((r["mark"], r["lang"], bytes(r["hashes"]), bytes(r["counts"])) for r in found.collect())
    return fit([(r[1], np.frombuffer(r[2], np.uint16), np.frombuffer(r[3], np.uint32)) for r in rows])


def _judged(model: Model | None, texts: list[bytes], letters: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    if model is None or not texts:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    p, strange = model.judged(texts)
    best = p.argmax(axis=1)
    score = np.where(letters, p[np.arange(len(p)), best], 0.0)
    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)]
    return names, score, ~letters | strange | (score < model.threshold)


def _with_letters(docs: DataFrame, text: str) -> Column:
    return F.coalesce(F.rlike(column(docs, text), F.lit(r"\p{L}")), F.lit(False))


def predict(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: `doc_id`, `held_out`, `lang_pred`, `score`, `rejected`.

    Null texts and texts without a letter are `und`, score 0, rejected; so is every text without a
    model. A text strange to its predicted language keeps that prediction and score, and is rejected. Texts are read whole, a bounded number of bytes at a time.
    """
    key = column(docs, doc_id)
    rows = docs.select(
        key.alias("doc_id"), held_out(key).alias("held_out"), column(docs, text).alias("text"),
        _with_letters(docs, text).alias("letters"),
    )
    schema = rows.select(
        "doc_id", "held_out", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected")
    ).schema

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, run in text_slices(batch.column(2)):
                part = batch.slice(start, len(run))
                letters = part.column(3).to_numpy(zero_copy_only=False)
                names, score, rejected = _judged(model, run, letters)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
                    names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
                )

    return rows.mapInArrow(compute, schema)


def accepted(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows of `docs` that are not rejected, columns as they are."""
    at = docs.columns.index(text)
    # plain names on the way, as those given may hold dots
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.select(*[column(docs, c).alias(n) for c, n in zip(docs.columns, names)])
    schema = rows.schema
    rows = rows.withColumn("letters", _with_letters(rows, names[at]))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, run in text_slices(batch.column(at)):
                part = batch.slice(start, len(run))
                letters = part.column(part.num_columns - 1).to_numpy(zero_copy_only=False)
                _, _, rejected = _judged(model, run, letters)
                kept = part.filter(pa.array(~rejected))
                yield pa.RecordBatch.from_arrays(kept.columns[:-1], names=names)

    return rows.mapInArrow(compute, schema).toDF(*docs.columns)

