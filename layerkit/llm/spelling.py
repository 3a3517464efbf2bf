"""Spelling variants grouped with a trie of letter counts.

The letters are dealt into groups and a word becomes the vector of its counts per group. Words are
arranged in a trie by these counts, one group after the other. One inserted, deleted or replaced letter
changes the counts by at most one surplus and one deficit, so a depth-first search that may
spend one of each finds every candidate; what it meets at the leaves is compared letter by letter.

The first levels of the trie, its head, tell where a branch lies: Spark sends a word as a leaf to its
own branch and as a query to the branches within its budget that exist. A task sorts the leaves of
a branch and lets the queries pass by in batches. The head has as many levels as it takes for branches
to be small; one that stays larger (words with the same letters) is split by hash, and its
queries go to each part.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.llm.common import column, stored

RUN = r"[A-Za-zÀ-ÿ]+"
SHORTEST = 5
SEEN = 3
#: A word's form is at least so many times as frequent.
TIMES = 2
#: Leaves of a branch, or of a part of it, that one task holds at a time.
BRANCH = 4096
#: Letter groups are the code points with the same rest modulo 16; frequent letters lie on the first levels
#: (fixed order).
LEVELS = np.array([5, 4, 9, 1, 14, 3, 2, 15, 8, 12, 7, 6, 13, 0, 11, 10])
GROUPS = len(LEVELS)
_LEVEL_OF = np.argsort(LEVELS)
_FULL = 15
_PAIRS = 4 << 20


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", dropped: int | None = None) -> DataFrame:
    """(word): every run of letters of every whole text, A-Z lowered. With `dropped`, a run loses one
    letter where that number divides h, the CRC-32 of `<doc_id>:<run>`: the one at h modulo its length."""
    rows = docs.select(
        F.coalesce(column(docs, doc_id).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(column(docs, text), F.lit(RUN), F.lit(0))).alias("run"),
    )
    plain = F.octet_length("run") == F.char_length("run")
    lowered = F.when(plain, F.lower("run")).otherwise(F.translate("run", string.ascii_uppercase, string.ascii_lowercase))
    rows = rows.select("id", lowered.alias("run"))
    if dropped is None:
        return rows.select(F.col("run").alias("word"))
    rows = rows.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod("h", F.char_length("run")).cast("int")
    cut = F.concat(F.left("run", at), F.substr("run", at + 2))
    return rows.select(F.when(F.col("h") % dropped == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, shortest: int = SHORTEST, seen: int = SEEN) -> DataFrame:
    """(word, n) of the words of at least `shortest` code points that occur `seen` times and more; counted
    where they are before they are shuffled."""
    counts = words.where(F.char_length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= seen)


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, and their lengths."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return flat, np.fromiter(map(len, words), np.int64, len(words))


def vectors(words: list[str]) -> np.ndarray:
    """Letter counts of each word, in the order of the trie's levels."""
    flat, sizes = _codes(words)
    owner = np.repeat(np.arange(len(words)), sizes)
    cells = owner * GROUPS + _LEVEL_OF[flat % GROUPS]
    return np.bincount(cells, minlength=len(words) * GROUPS).reshape(len(words), GROUPS)


def _head(counts: np.ndarray) -> np.ndarray:
    """The first levels in one number, four bits each; large counts share the last value."""
    shifts = 4 * np.arange(counts.shape[-1], dtype=np.int64)
    return (np.minimum(counts, _FULL) << shifts).sum(axis=-1, dtype=np.int64)


def _moves(depth: int) -> np.ndarray:
    """Changes of the head within budget. A deficit is spent after the surplus only: the pair is found
    from the other word otherwise."""
    one = np.eye(depth, dtype=np.int64)
    both = [one[i] - one[j] for i in range(depth) for j in range(i + 1, depth)]
    return np.array([one[0] * 0, *one, *both])


def _heads(words: DataFrame, depth: int) -> DataFrame:
    """`words` with `head`, their branch."""
    fields = "word string, n bigint, head bigint"

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            head = _head(vectors(batch.column(0).to_pylist())[:, :depth])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(head)], names=["word", "n", "head"])

    return words.select("word", "n").mapInArrow(compute, fields)


def _asked(words: DataFrame, depth: int) -> DataFrame:
    """`words` once for every branch within their budget."""
    moves = _moves(depth)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 1024):
                part = batch.slice(start, 1024)
                own = vectors(part.column(0).to_pylist())[:, None, :depth]
                # a move that a full value hides leads where another one leads already
                fits = (own + moves >= 0) & ~((moves > 0) & (own >= _FULL)) & ~((moves < 0) & (own > _FULL))
                row, move = np.nonzero(fits.all(axis=2))
                head = _head(own[row, 0] + moves[move])
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(head)], names=["word", "n", "head"]
                )

    return words.select("word", "n").mapInArrow(compute, "word string, n bigint, head bigint")


def candidates(leaves: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, leaf) places whose vectors lie within the budget: depth first through the trie of the
    sorted `leaves`, all queries at once, each with what it has spent: 0 nothing, 1 the surplus,
    2 the deficit as well."""
    found_q, found_l = [], []
    stack = [(0, len(leaves), 0, np.arange(len(queries)), np.zeros(len(queries), np.int8))]
    while stack:
        a, b, level, asking, spent = stack.pop()
        if not len(asking):
            continue
        if level == GROUPS or b - a <= 8 or (b - a) * len(asking) <= 4096:
            for start in range(0, len(asking), max(1, 65536 // (b - a))):
                some = slice(start, start + max(1, 65536 // (b - a)))
                q, leaf = _within(leaves[a:b, level:], queries[asking[some], level:], spent[some])
                found_q.append(asking[some][q])
                found_l.append(a + leaf)
            continue
        values = leaves[a:b, level]
        edges = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [b - a]])
        wanted = queries[asking, level]
        for i, j in zip(edges[:-1], edges[1:]):
            change = values[i] - wanted
            goes = (change == 0) | ((change == 1) & (spent == 0)) | ((change == -1) & (spent == 1))
            stack.append((a + i, a + j, level + 1, asking[goes], spent[goes] + (change[goes] != 0).astype(np.int8)))
    if not found_q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_q), np.concatenate(found_l)


def _within(leaves: np.ndarray, queries: np.ndarray, spent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that the rest of the budget allows, over all remaining levels at once."""
    if not leaves.shape[1]:
        return tuple(x.ravel() for x in np.indices((len(queries), len(leaves))))
    change = leaves[None] - queries[:, None]
    more, less = change == 1, change == -1
    surplus, deficit = more.sum(axis=2), less.sum(axis=2)
    exact = ((change != 0).sum(axis=2) == surplus + deficit) & (surplus <= 1) & (deficit <= 1)
    used = spent[:, None]
    # the surplus first, the deficit after it
    first = (surplus == 0) | (deficit == 0) | (more.argmax(axis=2) < less.argmax(axis=2))
    fits = np.where(used == 0, (deficit <= surplus) & first, (surplus == 0) & ((deficit == 0) | (used == 1)))
    return np.nonzero(exact & fits)


def one_edit(short: tuple[np.ndarray, np.ndarray], long: tuple[np.ndarray, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether words i of `short` and j of `long` (code points, lengths), the latter of the same length or
    one longer, differ by exactly one letter."""
    (a_flat, a_sizes), (b_flat, b_sizes) = short, long
    a_start, b_start = np.cumsum(a_sizes) - a_sizes, np.cumsum(b_sizes) - b_sizes
    answer = np.zeros(len(i), bool)
    order = np.argsort(b_sizes[j], kind="stable")
    start = 0
    while start < len(order):
        # the longest words go last, fewer at a time
        end = start + 1024
        while end > start + 1 and (min(end, len(order)) - start) * int(b_sizes[j[order[min(end, len(order)) - 1]]]) > _PAIRS:
            end = start + (end - start) // 2
        at = order[start:end]
        width = int(b_sizes[j[at]].max()) + 1

        def table(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
            place = np.arange(width)
            inside = place < sizes[:, None]
            return np.where(inside, np.append(flat, 0)[np.where(inside, starts[:, None] + place, len(flat))], 0)

        a = table(a_flat, a_start[i[at]], a_sizes[i[at]])
        b = table(b_flat, b_start[j[at]], b_sizes[j[at]])
        same = a == b
        prefix = np.logical_and.accumulate(same, axis=1).sum(axis=1)
        shifted = np.logical_and.accumulate((a[:, :-1] == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
        n = a_sizes[i[at]]
        inserted = (b_sizes[j[at]] == n + 1) & (prefix + shifted - (width - 1 - n) >= n)
        answer[at] = inserted | ((b_sizes[j[at]] == n) & ((~same).sum(axis=1) == 1))
        start = end
    return answer


def _near(leaf_words: list[str], leaf_n: np.ndarray, words: list[str], n: np.ndarray) -> pa.RecordBatch | None:
    """(word, n_near, best_n, best) over the pairs of leaves and queries, either word of a pair once."""
    leaf_vectors, query_vectors = vectors(leaf_words), vectors(words)
    order = np.lexsort(leaf_vectors.T[::-1])
    q, leaf = candidates(leaf_vectors[order], query_vectors)
    leaf = order[leaf]
    leaf_codes, codes = _codes(leaf_words), _codes(words)
    # words of the same vector meet from both sides
    same = (leaf_vectors[leaf] == query_vectors[q]).all(axis=1)
    once = ~same
    once[same] = [words[x] < leaf_words[y] for x, y in zip(q[same], leaf[same])]
    q, leaf = q[once], leaf[once]
    near = one_edit(codes, leaf_codes, q, leaf)
    q, leaf = q[near], leaf[near]
    if not len(q):
        return None
    both = words + leaf_words
    counts = np.concatenate([n, leaf_n])
    mine, other = np.concatenate([q, leaf + len(words)]), np.concatenate([leaf + len(words), q])
    # the most frequent other word first, the smallest of equals
    spelled = np.array(sorted(range(len(both)), key=both.__getitem__))
    rank = np.empty(len(both), np.int64)
    rank[spelled] = np.arange(len(both))
    by = np.lexsort([rank[other], -counts[other], mine])
    mine, other = mine[by], other[by]
    first = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))
    each = np.diff(np.append(first, len(mine)))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([both[x] for x in mine[first]], pa.string()), pa.array(each.astype(np.int64)),
            pa.array(counts[other[first]]), pa.array([both[x] for x in other[first]], pa.string()),
        ],
        names=["word", "n_near", "best_n", "best"],
    )


def near_words(words: DataFrame, branch: int = BRANCH) -> DataFrame:
    """(word, n_near, form, form_n) of the stored `words` (word, n) that have near words: how many, the most
    frequent of them and its count, of equals the smallest in code-point order."""
    rows = words.count()
    depth = min(GROUPS, max(1, (rows // branch).bit_length()))
    while True:
        leaves = _heads(words, depth)
        sizes = leaves.groupBy("head").agg(F.count("*").alias("leaves"))
        if depth == GROUPS or (sizes.agg(F.max("leaves")).first()[0] or 0) <= branch:
            break
        depth += 1
    parts = F.ceil(F.col("leaves") / branch).cast("int")
    sizes = stored(sizes.select("head", parts.alias("parts")), "branches")
    asked = _asked(words, depth).join(sizes, "head").select(
        "head", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("asks"), "word", "n"
    )
    held = leaves.join(sizes, "head").select(
        "head", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int").alias("part"), F.lit(False).alias("asks"), "word", "n"
    )
    routed = asked.unionByName(held).repartition("head", "part").sortWithinPartitions("head", "part", "asks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, leaf_words, leaf_n = None, [], []
        for batch in batches:
            head, part = (batch.column(c).to_numpy() for c in (0, 1))
            asks = batch.column(2).to_numpy(zero_copy_only=False)
            changes = (head[1:] != head[:-1]) | (part[1:] != part[:-1]) | (asks[1:] != asks[:-1])
            edges = np.concatenate([[0], np.flatnonzero(changes) + 1, [len(batch)]])
            for a, b in zip(edges[:-1], edges[1:]):
                if a == b:
                    continue
                if key != (head[a], part[a]):
                    key, leaf_words, leaf_n = (head[a], part[a]), [], []
                some, n = batch.column(3).slice(a, b - a).to_pylist(), batch.column(4).slice(a, b - a).to_numpy()
                if not asks[a]:
                    leaf_words, leaf_n = leaf_words + some, [*leaf_n, n]
                elif leaf_words:
                    found = _near(leaf_words, np.concatenate(leaf_n), some, n)
                    if found is not None:
                        yield found

    found = routed.mapInArrow(search, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("form")))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of the stored `links` (word, form): where following forms ends. Each round doubles the
    way gone; counts at least double with every step, so the rounds are few."""
    passed = links.select(F.col("form").alias("word")).distinct()
    steps = stored(links.join(passed, "word", "left_semi"), "steps")
    while True:
        onward = steps.select(F.col("word").alias("at"), F.col("form").alias("next"))
        moved = steps.join(onward, F.col("form") == F.col("at"), "left")
        moved = moved.select("word", F.coalesce("next", "form").alias("form"), F.col("next").isNotNull().alias("moved"))
        moved = stored(moved, "steps")
        steps = moved.drop("moved")
        if moved.where("moved").isEmpty():
            break
    last = steps.select(F.col("word").alias("at"), F.col("form").alias("last"))
    return links.join(last, F.col("form") == F.col("at"), "left").select("word", F.coalesce("last", "form").alias("root"))


def variants(words: DataFrame, times: int = TIMES, branch: int = BRANCH) -> DataFrame:
    """One row per word of `words` (word, n): `word`, `n`, `n_near`, `form`, `form_n`, `root`.

    Two words are near if one inserted, deleted or replaced code point makes one of the other. A word's
    form is its most frequent near word, the smallest in code-point order of equals, if that is at
    least `times` (more than 1) as frequent, else null; `root` is where following forms ends, the word itself without a
    form; `n_near` is 0 without near words. Words are distinct and not null; an empty table gives no rows.
    """
    words = stored(words.select("word", "n"), "words")
    near = stored(near_words(words, branch), "near")
    joined = words.join(near, "word", "left")
    has: Column = F.col("form_n") >= F.lit(times) * F.col("n")
    formed = stored(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has, F.col("form")).alias("form"), F.when(has, F.col("form_n")).alias("form_n"),
    ), "formed")
    ends = roots(formed.where("form IS NOT NULL").select("word", "form"))
    return formed.join(ends, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
