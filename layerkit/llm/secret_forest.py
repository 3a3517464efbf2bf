"""Secret scan with a random forest that removes false findings, in DataFrame operations.

Candidates are runs of the characters that keys are written in. A forest over their length, the
changes between kinds of characters, how much of them a dictionary covers, the path they are found
under and the words around them tells secrets from other strings. It is trained on a bounded sample
of judged findings, or on planted ones; the dictionary is counted over all texts.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.llm.common import column, stored

_KEY = r"A-Za-z0-9+/_\-"
#: Shortest candidates: anywhere, and behind '=' or ':'. Below them the forest has no say.
SHORTEST, SHORTEST_ASSIGNED = 8, 4


def _candidate(shortest: int, assigned: int) -> str:
    """A run of key characters, with '=' as padding at its end only: name=value is a name and a value."""
    return (
        rf"(?<![{_KEY}])(?:[{_KEY}]{{{shortest},}}+|(?<=[=:]\s{{0,4}}[\"'`]?)[{_KEY}]{{{assigned},}}+)"
        rf"(?:={{1,2}}(?![{_KEY}=]))?"
    )


#: Characters of text looked at before and after a candidate.
AROUND = 48
#: Words in the dictionary, the most frequent ones of three to eight letters.
DICTIONARY = 512
#: The most labelled findings the forest is trained on.
TRAIN_ROWS = 20_000
#: Planted texts to train on where no judged findings are given.
PLANTED = 12_000
TREES, DEPTH = 24, 6
THRESHOLD = 0.5

CREDENTIAL = r"(?i)(token|secret|passw|passphrase|api.?key|access.?key|private.?key|auth|credential|bearer)"
HARMLESS = r"(?i)(example|sample|dummy|placeholder|commit|revision|digest|checksum|md5|sha\d|uuid|version)"
TEST_PATH = r"(?i)(test|example|sample|mock|fixture|doc)"

NAMED = CREDENTIAL + r"[\w.\-]{0,24}[\"'`]?\s{0,4}:?[=:]\s{0,4}[\"'`]?$"

_PLANTED_WORDS = ["hunter", "dragon", "summer", "monkey", "soleil", "garten", "correct", "horse", "battery", "ciudad", "tiger", "welcome"]
_PLANTED_NAMES = [
    "password", "Password", "passwd", "DB_PASSWORD", "token", "access_token", "auth_token", "api_key", "API_KEY", "apiKey", "secret",
    "client_secret", "SECRET_KEY", "aws_secret_access_key", "AWS_ACCESS_KEY_ID", "private_key", "passphrase", "credential",
]
_PLANTED_FREE = ["name", "title", "count", "id", "path", "file", "order", "phone", "url", "type", "number", "description"]
_PLANTED_HARMLESS = ["commit", "sha256", "md5", "checksum", "digest", "revision", "uuid", "version", "example", "sample", "MD5", "Commit"]
_PLANTED_STANDINS = [
    "your_token_here", "your-password", "REPLACE_ME_NOW", "xxxxxxxxxxxx", "get_password", "settings", "process", "read_secret_file",
    "placeholder", "example-token", "required", "undefined", "--------", "config/credentials",
]
_PLANTED_PROSE = [
    "", "The report was sent on Monday and nobody answered. ", "we wait for the others\n", "Das Haus am See ist seit Jahren verkauft, ",
    "la maison de la rue est grande et vieille. ", "el informe fue enviado ayer por la tarde; ", "x = 1\n", "# settings\n",
]

FEATURES = (
    "n_chars", "digits", "lowers", "uppers", "hexes", "marks", "letter_digit", "digit_letter", "case_changes",
    "distinct_chars", "covered", "assigned", "quoted", "named", "credential_before", "harmless_before", "credential_after",
    "credential_inside", "names",
    "words_before", "test_path", "path_depth",
)
_AROUND_FEATURES = (
    "assigned", "quoted", "named", "credential_before", "harmless_before", "credential_after", "names",
    "words_before", "test_path", "path_depth",
)


def dictionary(docs: DataFrame, text: str = "text", size: int = DICTIONARY) -> list[str]:
    """The `size` most frequent words of three to eight letters a-z over all texts, ties by
    word. Words are counted where they are before they are shuffled."""
    found = F.regexp_extract_all(F.lower(column(docs, text)), F.lit(r"(?<![a-z])[a-z]{3,8}+(?![a-z])"), F.lit(0))
    counts = docs.select(F.explode(found).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(size).collect()]


def _says(text: Column, pattern: str) -> Column:
    # lower case once is cheaper than patterns that ignore case
    return F.rlike(F.lower(F.coalesce(text, F.lit(""))), F.lit(pattern.replace("(?i)", "")))


def candidates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source",
    shortest: int = SHORTEST, shortest_assigned: int = SHORTEST_ASSIGNED, around: int = AROUND,
) -> DataFrame:
    """(doc_id, path, ordinal, candidate, before, after): every candidate of every whole text, with
    what stands around it in the text, other candidates included; with `credential` and `harmless`, whether
    such words are anywhere in the text, and what the path says."""
    value, pattern = column(docs, text), _candidate(shortest, shortest_assigned)
    where = column(docs, path).cast("string")
    rows = docs.select(
        column(docs, doc_id).alias("doc_id"), where.alias("path"),
        F.regexp_extract_all(value, F.lit(pattern), F.lit(0)).alias("found"), F.split(value, pattern, -1).alias("gaps"),
        _says(value, CREDENTIAL).alias("credential"), _says(value, HARMLESS).alias("harmless"),
        _says(where, TEST_PATH).cast("double").alias("test_path"), F.coalesce(_count(where, "/"), F.lit(0.0)).alias("path_depth"),
    ).where(F.size("found") > 0)
    # gap, candidate, gap, candidate ... gap: the text in order
    pairs = F.zip_with("gaps", "found", lambda gap, one: F.array(gap, F.coalesce(one, F.lit(""))))
    about = ["credential", "harmless", "test_path", "path_depth"]
    rows = rows.select("doc_id", "path", *about, "found", F.flatten(pairs).alias("pieces"))
    rows = rows.select("*", F.posexplode("found").alias("ordinal", "candidate"))
    place = F.col("ordinal") * 2 + 2

    def left(pieces: int) -> Column:
        first = F.greatest(F.lit(1), place - 1 - pieces)
        return F.array_join(F.slice("pieces", first, place - first), "")

    def right(pieces: int) -> Column:
        return F.array_join(F.slice("pieces", place + 1, pieces + 1), "")

    # a few pieces hold enough nearly always
    most = 2 * -(-around // (min(shortest, shortest_assigned) + 1))
    before, after = (F.when(F.length(of(4)) >= around, of(4)).otherwise(of(most)) for of in (left, right))
    return rows.select(
        "doc_id", "path", F.col("ordinal").cast("bigint").alias("ordinal"), "candidate",
        F.right(before, F.lit(around)).alias("before"), F.left(after, F.lit(around)).alias("after"), *about,
    )


def _count(text: Column | str, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _any_of(words: list[str]) -> str:
    """A pattern for the longest of the words at a place, as a tree of their letters."""
    ends = "" in words
    heads: dict[str, list[str]] = {}
    for word in sorted(w for w in words if w):
        heads.setdefault(word[0], []).append(word[1:])
    if not heads:
        return ""
    tree = "|".join(head + _any_of(tails) for head, tails in heads.items())
    return f"(?:{tree})" + ("?" if ends else "")


#: Every character of a candidate as its kind: 0 digit, h and l lower case with and without a-f, H and U upper
#: case, - anything else.
_KINDS = (
    string.digits + string.ascii_lowercase + string.ascii_uppercase + "+/_-=",
    "0" * 10 + "h" * 6 + "l" * 20 + "H" * 6 + "U" * 20 + "-" * 5,
)


def own_features(found: DataFrame, words: list[str]) -> DataFrame:
    """`found` with the features that a candidate has by itself; shares are of its length."""
    rest = F.regexp_replace(F.lower("candidate"), _any_of(words), "") if words else F.lower("candidate")
    rows = found.withColumn("_kinds", F.translate("candidate", *_KINDS))
    rows = rows.withColumn("_cases", F.translate("_kinds", "hlHU", "aaAA"))
    size = F.length("candidate").cast("double")

    def times(kinds: str, *runs: str) -> Column:
        gone = [F.length(kinds) - F.length(F.replace(kinds, F.lit(r), F.lit(""))) for r in runs]
        return sum(gone[1:], gone[0]) / len(runs[0]) / size

    values = {
        "n_chars": size,
        "digits": times("_kinds", "0"), "lowers": times("_kinds", "h", "l"), "uppers": times("_kinds", "H", "U"),
        "hexes": times("_kinds", "0", "h", "H"), "marks": times("_kinds", "-"),
        "letter_digit": times("_cases", "a0", "A0"), "digit_letter": times("_cases", "0a", "0A"),
        "case_changes": times("_cases", "aA", "Aa"),
        "distinct_chars": F.size(F.array_distinct(F.split("candidate", ""))) / size,
        "covered": F.lit(1.0) - F.length(rest) / size,
        "credential_inside": _says(F.col("candidate"), CREDENTIAL).cast("double"),
    }
    return rows.select("*", *[F.coalesce(v, F.lit(0.0)).alias(n) for n, v in values.items()]).drop("_kinds", "_cases")


def context_features(found: DataFrame) -> DataFrame:
    """`found` with the features of the words around a candidate. Credential words and the like are looked
    for only in texts that have them somewhere."""
    quotes = [F.lit(q) for q in ("\"", "'", "`")]
    sign = lambda name: F.contains(name, F.lit("=")) | F.contains(name, F.lit(":"))
    said = lambda known, name, pattern: F.when(F.col(known), _says(F.col(name), pattern).cast("double"))
    assigned = sign(F.col("before")) & F.rlike("before", F.lit(r"[=:]\s*[\"'`]?$"))
    quoted = F.right("before", F.lit(1)).isin(*quotes) & F.left("after", F.lit(1)).isin(*quotes)
    values = {
        "assigned": assigned.cast("double"),
        "quoted": quoted.cast("double"),
        "named": F.when(assigned, said("credential", "before", NAMED)),
        "credential_before": said("credential", "before", CREDENTIAL),
        "harmless_before": said("harmless", "before", HARMLESS),
        "credential_after": said("credential", "after", CREDENTIAL),
        "names": F.when(sign(F.col("after")), F.rlike("after", F.lit(r"^[\"'`]?\s{0,4}:?[=:]")).cast("double")),
        "words_before": _count("before", r"[\p{L}]{2,}+"),
    }
    return found.select("*", *[F.coalesce(v, F.lit(0.0)).alias(n) for n, v in values.items()])


def with_features(found: DataFrame, words: list[str]) -> DataFrame:
    """`found` with the columns of `FEATURES`."""
    return own_features(context_features(found), words)


def _pick(seed: int, values: list) -> Column:
    """One of the values by a hash of the row's id."""
    options = F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values])
    return F.get(options, F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(len(values))).cast("int"))


def _cut(text: Column, seed: int, least: int, most: int) -> Column:
    return F.left(text, F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(most - least + 1)).cast("int") + least)


def planted(spark: SparkSession, rows: int = PLANTED) -> DataFrame:
    """(doc_id, text, source, value, secret): made-up texts whose findings are judged because it is
    known what was put in: `value` is a secret or not, every other candidate is none."""
    some = spark.range(rows)
    hexes = F.sha2(F.concat(F.lit("a"), F.col("id")).cast("binary"), 256)
    b64 = F.base64(F.unhex(F.sha2(F.concat(F.lit("b"), F.col("id")).cast("binary"), 256)))
    b62 = F.regexp_replace(b64, "[+/=]", "")
    letters, digits = F.lower(F.regexp_replace(b64, "[^A-Za-z]", "")), F.regexp_replace(hexes, "[a-f]", "")
    word, other = _pick(1, _PLANTED_WORDS), _pick(2, _PLANTED_WORDS)
    uuid = F.regexp_replace(F.left(hexes, F.lit(32)), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-")
    strong = _pick(3, [
        F.left(hexes, F.lit(32)), F.left(hexes, F.lit(40)), hexes, b64, _cut(b62, 4, 16, 40),
        F.concat(_pick(5, ["sk_live_", "ghp_", "xoxb-", "key-", "glpat-"]), _cut(b62, 6, 16, 36)),
        F.concat(F.lit("AKIA"), F.upper(F.left(b62, F.lit(16)))),
    ])
    short = _pick(7, [_cut(b62, 8, 8, 15), F.concat(word, _cut(digits, 9, 1, 4), _cut(b62, 10, 0, 4)), F.concat(F.initcap(word), F.lit("_"), _cut(digits, 9, 2, 5))])
    plain = _pick(11, [_cut(digits, 12, 4, 16), _cut(letters, 13, 8, 20), F.concat(word, other)])
    name, free, harmless = _pick(14, _PLANTED_NAMES), _pick(15, _PLANTED_FREE), _pick(16, _PLANTED_HARMLESS)
    given = _pick(17, ['# = "|"', "# = '|'", '#: "|"', "#=|", "#: |", '"#": "|"', "?page=2&#=|&lang=en", '# := "|"', "export #=|\n", "--#=| ", "#:|"])
    told = _pick(18, ["Authorization: Bearer |", "the # is |.", "# |", '"|"', "`|`", " | "])
    prose = _pick(19, ["|", "|.", "|,", "(|)", "Note: |.", "the # was | and", "# of the |", "the | #"])
    called = _pick(20, ["# |", "#: |", '# = "|"', "#=|", '"#": "|"', "# | "])
    used = _pick(21, ["# = |(", "#: |", "# = |.get", '# = "|"', "#=|"])
    kinds = [
        # (secret, times, value, text around, name)
        (1, 5, strong, given, name), (1, 5, short, given, name), (1, 5, plain, given, name), (1, 3, strong, told, name),
        (0, 5, _pick(22, [hexes, F.left(hexes, F.lit(40)), F.left(hexes, F.lit(32)), uuid, b64]), called, harmless),
        (0, 5, _pick(23, [letters, F.initcap(letters), F.concat(word, other)]).substr(F.lit(1), F.pmod("id", F.lit(17)).cast("int") + 8), prose, name),
        (0, 3, _cut(digits, 24, 8, 20), prose, free), (0, 3, _pick(25, [plain, F.concat(word, F.lit("_"), other), F.concat(F.lit("/usr/"), word, F.lit("/"), other)]), given, free),
        (0, 2, _pick(26, _PLANTED_STANDINS), used, name),
    ]
    turns = [k for k, kind in enumerate(kinds) for _ in range(kind[1])]
    kind = F.get(F.array(*[F.lit(k) for k in turns]), F.pmod("id", F.lit(len(turns))).cast("int"))

    def of(column: int) -> Column:
        return F.get(F.array(*[F.lit(k[column]) if isinstance(k[column], int) else k[column] for k in kinds]), kind)

    some = some.select("id", of(0).alias("secret"), of(2).alias("value"), of(3).alias("form"), of(4).alias("name"))
    text = F.replace(F.replace("form", F.lit("#"), F.col("name")), F.lit("|"), F.col("value"))
    return some.select(
        F.col("id").alias("doc_id"), F.concat(_pick(27, _PLANTED_PROSE), text, F.lit(" "), _pick(28, _PLANTED_PROSE)).alias("text"),
        _pick(29, ["src", "docs/web", "a/b/c", "test/unit", "mail"]).alias("source"), "value", "secret",
    )


def labelled(spark: SparkSession, words: list[str], rows: int = PLANTED) -> DataFrame:
    """Findings of the planted texts with `FEATURES` and `label`. No label follows from a feature."""
    texts = planted(spark, rows)
    known = texts.select(F.col("doc_id").alias("_doc_id"), "value", "secret")
    found = with_features(candidates(texts), words)
    found = found.join(F.broadcast(known), F.col("doc_id") == F.col("_doc_id"))
    return found.withColumn("label", F.when(F.col("candidate") == F.col("value"), F.col("secret")).otherwise(0).cast("double"))


def train(findings: DataFrame, rows: int = TRAIN_ROWS) -> RandomForestClassificationModel | None:
    """Forest over rows with `FEATURES` and `label`, at most `rows` of them chosen by hash, half of
    them of either label if there are so many. None without findings of both labels: nothing is
    decided then."""
    counts = {r["label"]: r["n"] for r in findings.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not counts.get(1.0) or not counts.get(0.0):
        return None
    mark = F.xxhash64(F.lit(3), *FEATURES, "doc_id", "ordinal")
    parts = []
    for label, n in sorted(counts.items()):
        some = findings.where(F.col("label") == label).withColumn("mark", mark)
        some = some.where(F.pmod("mark", F.lit(1 << 20)) < F.lit(int(min(1.0, rows / n) * (1 << 20))))
        parts.append(some.orderBy("mark").limit(rows // 2))
    sample = parts[0].unionByName(parts[1]).select(*FEATURES, "label", "mark")
    sample = stored(sample.coalesce(1).sortWithinPartitions("mark", "label"), "labelled").coalesce(1)
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=7, labelCol="label", featuresCol="features",
        probabilityCol="chances", predictionCol="verdict", rawPredictionCol="votes",
    )
    return forest.fit(_assembled(sample))


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def judged(featured: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """`featured` with `score`, the forest's share of votes for a secret; null without a forest."""
    if model is None:
        return featured.withColumn("score", F.lit(None).cast("double"))
    scored = model.transform(_assembled(featured))
    return scored.withColumn("score", vector_to_array("chances")[1]).drop("features", "votes", "chances", "verdict")


def findings(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source", labels: DataFrame | None = None,
    shortest: int = SHORTEST, shortest_assigned: int = SHORTEST_ASSIGNED, around: int = AROUND, dictionary_size: int = DICTIONARY,
) -> DataFrame:
    """One row per candidate: `doc_id`, `ordinal` (from 0 within its text), `candidate_sha256`,
    `n_chars`, `covered`, `score` and `is_secret`.

    Candidates are runs of key characters, `shortest` and longer, `shortest_assigned` behind `=` or `:`; 1 scores every
    run. The words of `around` characters before and after count, and the `dictionary_size` most frequent words.
    `labels` (doc_id, ordinal, label) are judged findings to train on; without them those of planted
    texts are taken. If the labels hold no secret or nothing else, `score` and `is_secret` are null:
    undecided. Null and empty texts have no candidates; null paths and ids are allowed;
    repeated rows give repeated findings. An empty table gives no rows.
    """
    words = dictionary(docs, text, dictionary_size)
    spots = context_features(candidates(docs, doc_id, text, path, shortest, shortest_assigned, around))
    whole = {f: F.col(f).cast("int") for f in _AROUND_FEATURES}
    spots = stored(spots.select("doc_id", "ordinal", "candidate", *[c.alias(f) for f, c in whole.items()]), "spots")
    # what a candidate has by itself is found once per distinct one
    own = own_features(spots.select("candidate").distinct(), words).withColumn("candidate_sha256", F.sha2("candidate", 256))
    own = stored(own, "distinct")
    found = spots.join(own, "candidate").withColumns({f: F.col(f).cast("double") for f in _AROUND_FEATURES})
    if labels is None:
        known = stored(labelled(docs.sparkSession, words), "planted")
    else:
        given = labels.select(*[column(labels, c).alias(f"_{c}") for c in ("doc_id", "ordinal", "label")])
        known = found.join(
            given, found["doc_id"].eqNullSafe(given["_doc_id"]) & (found["ordinal"] == given["_ordinal"])
        ).withColumn("label", F.col("_label").cast("double")).where("label is not null")
    scored = judged(found, train(known))
    return scored.select(
        "doc_id", "ordinal", "candidate_sha256", F.col("n_chars").cast("bigint").alias("n_chars"),
        "covered", "score", (F.col("score") >= THRESHOLD).alias("is_secret"),
    )
