"""Personal data: fixed forms, and identifiers that their context gives away.

Matches of the fixed forms are seeds. The words around them are lexical patterns, and the same
patterns also stand around other strings: a graph of patterns and instances. A pattern is as good as the
instances it extracts, an instance as good as the patterns that extract it; Spark scores both in turns.
What stands in a pattern of high confidence and is shaped like the kind is personal data too,
such as a phone number without its country or a mail address spelled out.

The work in tasks is finding matches and hashing contexts; scores are joins and sums over distinct
(pattern, instance) pairs, so a number that is copied a million times counts once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.llm.common import column, stored

KINDS = ("email", "ip", "card", "phone")
#: Distinct seeds a pattern needs, and the confidence from which it tells of others.
SEEDS, CONFIDENT = 3, 0.8
#: Confidence from which a pattern says anything on its instances.
RELIABLE = 0.5
ROUNDS = 3
#: Code points of text before and after a match in which its context is looked for.
AROUND = 80

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# a run of digits matches from its first digit or not at all, so it is tried only there
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")

#: Other strings that may be identifiers: what has a digit or an @ between white space, and addresses spelled out.
_MARKED = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
_SPELLED = re.compile(
    r"(?:\x20?[\[({]\x20?at\x20?[\])}]\x20?|\x20at\x20(?=[A-Za-z0-9-]++(?:\x20dot\x20[A-Za-z0-9-]++)+))"
    r"[A-Za-z0-9-]++(?:(?:\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]++)+", re.I,
)
_TRIM = ".,;:!?'\"<>[]{}"
_NUMBER = re.compile(r"[+(]?[0-9][0-9().-]*")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\w\s]|_")

_SPAN = "struct<start:bigint,kind:int,end:bigint>"
_SEEN = "struct<kind:int,shapes:int,start:bigint,end:bigint,value:bigint,contexts:array<bigint>>"
_SEEN_TYPE = pa.struct([
    ("kind", pa.int32()), ("shapes", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.int64()),
    ("contexts", pa.list_(pa.int64())),
])


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _local_part(text: str, at: int, least: int) -> int:
    """Where the characters allowed before the @ begin."""
    start = at
    while start > least and text[start - 1] in _LOCAL:
        start -= 1
    return start


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed forms, in that order; kinds by their place in `KINDS`."""
    found, done = [], 0
    for m in _DOMAIN.finditer(text):
        start = _local_part(text, m.start(), done)
        if start < m.start():
            found.append((start, 0, m.end()))
            done = m.end()
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in m.groups()):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.sub("", m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] in _TRIM:
        start += 1
    while end > start and text[end - 1] in _TRIM:
        end -= 1
    if end > start and text[start] == "(" and text[end - 1] == ")":
        start, end = start + 1, end - 1
    return start, end


def other_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, shapes, end) of other strings that are shaped like identifiers, apart from `base`; a bit of
    `shapes` for each kind it may be. Numbers with a blank between them are one."""
    found: list[tuple[int, int]] = []
    numeric = False
    for m in _MARKED.finditer(text):
        start, end = _trimmed(text, *m.span())
        if found and start - found[-1][1] == 1 and text[found[-1][1]] == " ":
            a = found[-1][0]
            if _NUMBER.fullmatch(text, start, end) and numeric:
                found[-1] = (a, end)
                continue
        if start < end:
            found.append((start, end))
            numeric = bool(_NUMBER.fullmatch(text, start, end))
    done = 0
    for m in _SPELLED.finditer(text):
        start = _local_part(text, m.start(), done)
        if start < m.start():
            found.append((start, m.end()))
            done = m.end()
    out, at, ends = [], 0, 0
    for start, end in sorted(found):
        # how far the base spans reach that begin before `end`
        while at < len(base) and base[at][0] < end:
            ends, at = max(ends, base[at][2]), at + 1
        shapes = _shapes(text[start:end]) if ends <= start else 0
        if shapes:
            out.append((start, shapes, end))
    return out


def _shapes(value: str) -> int:
    """Kinds a string may be by its characters, one bit each."""
    digits = _DIGITS.sub("", value)
    low = value.lower()
    mail = "@" in value[1:-1] or bool(_SPELLED.search(low))
    parts = re.split("[.:]", low)
    ip = len(parts) >= 3 and len(value) >= 5 and bool(re.fullmatch("[0-9a-f.:]+", low)) and bool(digits)
    plain = not re.search(r"[^0-9\x20().+/-]", value)
    return mail | ip << 1 | (plain and 12 <= len(digits) <= 19) << 2 | (plain and 7 <= len(digits) <= 15) << 3


def _value(value: str) -> int:
    """Hash of the instance: digits of a number, lower case of anything else."""
    plain = not re.search(r"[^0-9\x20()+/-]", value)
    return _signed(xxhash.xxh64_intdigest((_DIGITS.sub("", value) if plain else value.lower()).encode()))


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def contexts(text: str, start: int, end: int) -> list[int]:
    """Hashes of the lexical patterns around a place: the two and the three tokens before it, and one
    before with one behind. Numbers are alike; the ends of the text are tokens."""
    left = [t.lower() if not t.isdigit() else "#" for t in _TOKEN.findall(text[max(0, start - AROUND) : start])]
    right = _TOKEN.search(text, end, end + AROUND)
    left = ["^"] * (3 - len(left)) + left[-3:]
    behind = "$" if right is None else "#" if right.group().isdigit() else right.group().lower()
    patterns = ["3 " + " ".join(left), "2 " + " ".join(left[1:]), f"1 {left[2]} {behind}"]
    return [_signed(xxhash.xxh64_intdigest(p.encode())) for p in patterns]


def _extracted(text: str) -> tuple[list[dict], list[dict]]:
    base = base_spans(text)
    seen = [(k, 0, a, b) for a, k, b in base] + [(-1, shapes, a, b) for a, shapes, b in other_spans(text, base)]
    return (
        [{"start": a, "kind": k, "end": b} for a, k, b in base],
        [
            {"kind": k, "shapes": shapes, "start": a, "end": b, "value": _value(text[a:b]), "contexts": contexts(text, a, b)}
            for k, shapes, a, b in seen
        ],
    )


def extracted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, base, seen) per document: spans of the fixed forms, and all places with their contexts."""
    rows = docs.select(column(docs, doc_id).alias("doc_id"), column(docs, text).alias("text"))
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
    schema = rows.select("doc_id", F.array().cast(f"array<{_SPAN}>").alias("base"), F.array().cast(f"array<{_SEEN}>").alias("seen")).schema

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                both = [_extracted(t) if t else ([], []) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([b for b, _ in both], pa.list_(span)), pa.array([s for _, s in both], pa.list_(_SEEN_TYPE))],
                    names=["doc_id", "base", "seen"],
                )

    return rows.mapInArrow(compute, schema)


def _each_kind(of) -> list[Column]:
    return [of(k, name) for k, name in enumerate(KINDS)]


def pattern_scores(places: DataFrame, seeds: int = SEEDS, rounds: int = ROUNDS) -> DataFrame:
    """(context, email, ip, card, phone): confidence of the patterns with at least `seeds` distinct seeds
    of a kind, from `places` (kind, shapes, value, context).

    A pattern's confidence in a kind is the sum of its distinct instances' over their number and one.
    Seeds have 1 in their own kinds and 0 in others; another string has 1 - Π(1 - c) over the
    reliable patterns c it stands in, for kinds of its shape.
    """
    own = F.when(F.col("kind") >= 0, F.call_function("shiftleft", F.lit(1), F.greatest(F.col("kind"), F.lit(0)))).otherwise(0)
    pairs = stored(places.groupBy("context", "value").agg(F.bit_or(own).alias("seed"), F.bit_or("shapes").alias("shapes")), "pairs")

    def bit(mask: str, k: int) -> Column:
        return F.col(mask).bitwiseAND(F.lit(1 << k)) != 0

    known = pairs.groupBy("context").agg(*_each_kind(lambda k, name: F.count_if(bit("seed", k)).alias(name)))
    known = known.where(F.greatest(*[F.col(name) for name in KINDS]) >= seeds).select("context")
    instances = pairs.groupBy("value").agg(F.bit_or("seed").alias("known"))
    edges = pairs.drop("seed").join(known, "context", "left_semi").join(instances, "value")
    edges = stored(edges, "edges")
    scores = None
    for _ in range(rounds):
        if scores is None:
            trust = edges.select("value").distinct().select("value", *_each_kind(lambda k, name: F.lit(0.0).alias(name)))
        else:
            doubt = _each_kind(lambda k, name: F.exp(F.sum(F.when(
                (F.col(name) >= RELIABLE) & bit("shapes", k), F.log1p(-F.least(F.col(name), F.lit(0.999)))
            ).otherwise(0.0))).alias(name))
            trust = edges.where("known = 0").join(scores, "context").groupBy("value").agg(*doubt)
            trust = trust.select("value", *_each_kind(lambda k, name: (1 - F.col(name)).alias(name)))
        weighed = edges.join(trust, "value", "left")
        sums = _each_kind(lambda k, name: F.sum(
            F.when(F.col("known") != 0, bit("known", k).cast("double")).otherwise(F.coalesce(name, F.lit(0.0)))
        ).alias(name))
        scores = weighed.groupBy("context").agg(F.count("*").alias("n"), *sums)
        scores = stored(scores.select("context", *_each_kind(lambda k, name: (F.col(name) / (F.col("n") + 1)).alias(name))), "scores")
    return scores


def personal_data(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    seeds: int = SEEDS, confident: float = CONFIDENT, rounds: int = ROUNDS,
) -> DataFrame:
    """One row per document: `doc_id`, `base` and `learned`, arrays of (start, kind, end) in that order, counted in code
    points, `end` exclusive, kinds by their place in `KINDS`.

    `base` are the leftmost matches of the fixed forms that pass their checks. `learned` are other
    strings, apart from `base`, in a pattern of at least `confident`, of the kind it is most sure of.
    Null and empty texts have none; ids may be null or repeated; an empty table gives no rows.
    """
    found = extracted(docs, doc_id, text).withColumn("row", F.monotonically_increasing_id())
    found = stored(found, "extracted")
    spots = found.select("row", F.explode("seen").alias("s")).select("row", "s.*")
    spots = spots.select("*", F.explode("contexts").alias("context")).drop("contexts")
    scores = pattern_scores(spots.drop("row", "start", "end"), seeds, rounds)
    sure = scores.where(F.greatest(*[F.col(name) for name in KINDS]) >= confident)
    told = spots.where("kind < 0").join(sure, "context")
    fits = [
        F.when(F.col("shapes").bitwiseAND(F.lit(1 << k)) != 0, F.struct(F.col(name).alias("score"), F.lit(-k).alias("less")))
        for k, name in enumerate(KINDS)
    ]
    told = told.groupBy("row", "start", "end").agg(F.max(F.greatest(*fits)).alias("best")).where(F.col("best.score") >= confident)
    told = told.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        "start", (-F.col("best.less")).cast("int").alias("kind"), "end"
    ))).alias("learned"))
    return found.join(told, "row", "left").select("doc_id", "base", F.coalesce("learned", F.array().cast(f"array<{_SPAN}>")).alias("learned"))


def written(spans: Column) -> Column:
    """Spans as `kind:start:end`, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
