"""Token ids of documents in files of fixed-width packed integers.

An id takes as many bits as the largest id of the vocabulary. A file is

    blocks of packed ids, `BLOCK` ids each, the last one shorter, each starting at a byte
    the index: ids of documents, marks of null ids, tokens per document, byte offset of each block
    64 bytes of trailer: magic, bits, ids per block, ids, documents, blocks, place of the index

so any block is found by its offset and unpacked by shifts of whole arrays, and any token by its
number. Files hold documents in ascending id order, one range of ids each. They are written by the
tasks under a name of the attempt's own; only those named by the manifest, which Spark
commits, count, so repeated or lost tasks leave no wrong file behind.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain, compress, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerkit.llm.common import column, stored, text_slices
from layerkit.llm.words import tokens
from layerkit.session import new_path

END = 1
BLOCK = 1 << 16
MAGIC = 0x314449_4B504C
_TRAILER = 64
_KNOWN = 1 << 21
_SLICE = 2 << 20
MANIFEST = "shard int, path string, n_ids bigint, n_docs bigint"


def bits_for(vocabulary: int) -> int:
    """Bits that hold any id below `vocabulary`."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as little-endian bit string; 64 ids fill `bits` words of 64 bits."""
    lanes = np.zeros(-(-len(ids) // 64) * 64, np.uint64)
    lanes[: len(ids)] = ids
    lanes = lanes.reshape(-1, 64)
    words = np.zeros((len(lanes), bits), np.uint64)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        words[:, word] |= lanes[:, j] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, j] >> np.uint64(64 - shift)
    return words.astype("<u8").tobytes()[: -(-len(ids) * bits // 8)]


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    """The first `count` ids of a packed block, as unsigned 32-bit integers."""
    groups = -(-count // 64)
    whole = np.zeros(groups * bits * 8, np.uint8)
    whole[: len(data)] = np.frombuffer(data, np.uint8)
    words = whole.view("<u8").reshape(groups, bits)
    ids = np.empty((groups, 64), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        ids[:, j] = value & mask
    return ids.reshape(-1)[:count]


class Writer:
    """Writes one file; memory is bounded by a block and the index."""

    def __init__(self, sink, bits: int) -> None:
        self.sink, self.bits = sink, bits
        self.waiting: list[np.ndarray] = []
        self.held = self.n_ids = 0
        self.offsets = [0]
        self.docs: list[np.ndarray] = []
        self.nulls: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []

    def add(self, docs: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(docs.astype("<i8"))
        self.nulls.append(nulls.astype(np.uint8))
        self.lengths.append(lengths.astype("<u8"))
        self.waiting.append(ids)
        self.held += len(ids)
        self.n_ids += len(ids)
        if self.held >= BLOCK:
            self._flush(BLOCK)

    def _flush(self, least: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        at = 0
        while len(ids) - at >= least and at < len(ids):
            data = pack(ids[at : at + BLOCK], self.bits)
            self.sink.write(data)
            self.offsets.append(self.offsets[-1] + len(data))
            at += BLOCK
        self.waiting = [ids[at:]]
        self.held = max(0, len(ids) - at)

    def close(self) -> tuple[int, int]:
        """Finish the file; its numbers of ids and of documents."""
        self._flush(1)
        n_docs = sum(map(len, self.docs))
        for part in (*self.docs, *self.nulls, *self.lengths):
            self.sink.write(part.tobytes())
        self.sink.write(np.array(self.offsets, "<u8").tobytes())
        trailer = [MAGIC, self.bits, BLOCK, self.n_ids, n_docs, len(self.offsets) - 1, self.offsets[-1], 0]
        self.sink.write(np.array(trailer, "<u8").tobytes())
        self.sink.close()
        return self.n_ids, n_docs


class Reader:
    """Random access to one file opened for reading."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        source.seek(size - _TRAILER)
        head = np.frombuffer(source.read(_TRAILER), "<u8").astype(np.int64)
        if head[0] != MAGIC:
            raise ValueError("not a file of packed ids")
        self.bits, self.block, self.n_ids, self.n_docs, self.n_blocks = (int(x) for x in head[1:6])
        source.seek(int(head[6]))
        index = source.read(size - _TRAILER - int(head[6]))
        n = self.n_docs
        self.docs = np.frombuffer(index, "<i8", n)
        self.nulls = np.frombuffer(index, np.uint8, n, 8 * n).astype(bool)
        self.lengths = np.frombuffer(index, np.uint8, 8 * n, 9 * n).view("<u8").astype(np.int64)
        self.offsets = np.frombuffer(index[17 * n :], "<u8").astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])

    def read_block(self, number: int) -> np.ndarray:
        a, b = self.offsets[number], self.offsets[number + 1]
        self.source.seek(int(a))
        count = min(self.block, self.n_ids - number * self.block)
        return unpack(self.source.read(int(b - a)), count, self.bits)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids numbered `start` to `stop` in the file."""
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        found = np.concatenate([self.read_block(k) for k in range(first, last + 1)])
        return found[start - first * self.block : stop - first * self.block]

    def documents(self) -> Iterator[tuple[int, int]]:
        """(tokens, checksum) of the documents in order, reading every block once."""
        crc, seen, doc = 0, 0, 0
        for k in range(self.n_blocks):
            data = memoryview(self.read_block(k).astype("<u4").tobytes())
            at, n = 0, len(data) // 4
            while at < n:
                step = min(n - at, int(self.lengths[doc]) - seen)
                crc = zlib.crc32(data[4 * at : 4 * (at + step)], crc)
                at, seen = at + step, seen + step
                if seen == self.lengths[doc]:
                    yield seen, crc
                    crc, seen, doc = 0, 0, doc + 1


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


_TAIL = b".,;:!?)*$%&#|"


def _core(word: bytes) -> tuple[bytes, bytes]:
    """A run between white space as what it starts with and the marks it ends with, whose ids are
    those of both. Marks after an ASCII letter always start a token of their own; runs that could
    hold the name of a special token stay whole. ASCII is lower-cased, as the tokenizer does."""
    plain = word.isascii()
    if plain and word.isalpha():
        return word.lower(), b""
    if b"<|" in word:
        return word, b""
    core = word.rstrip(_TAIL)
    if not core[-1:].isalpha():
        core = word
    return (core.lower() if plain else core), word[len(core) :]


class WordEncoder:
    """Ids of texts by a tokenizer of the tokenizers library that lower-cases and never joins
    characters across white space, nor letters with other marks: every run between white space is
    encoded once and looked up after that, by its 64-bit hash, length, first and last byte, so a
    table of a million runs takes some 50 MB. The tables are emptied when full, which changes
    nothing but the time."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        self.final = np.zeros(tokenizer.get_vocab_size(), bool)
        for token, number in tokenizer.get_vocab().items():
            self.final[number] = token.endswith("</w>")
        self._clear()

    def _clear(self) -> None:
        self.n_pieces = 1
        self.pieces = np.array([hash(b"")])
        self.numbers = np.zeros(1, np.int32)
        self.ends = np.zeros(1 << 12, np.int32)
        self.flat = np.zeros(1 << 16, np.uint32)
        self.known = np.zeros(1, np.uint64)
        self.check = np.zeros(1, np.int64)
        self.parts = np.zeros((1, 2), np.int32)

    def _add(self, ids: Sequence[int], ends: np.ndarray) -> None:
        """Note the ids of new pieces: all one after the other, and where each one's end."""
        used, n = int(self.ends[self.n_pieces]), len(ends)
        self.flat = _room(self.flat, used + len(ids))
        self.ends = _room(self.ends, self.n_pieces + n + 1)
        self.flat[used : used + len(ids)] = ids
        self.ends[self.n_pieces + 1 : self.n_pieces + 1 + n] = used + ends
        self.n_pieces += n

    def _encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The pieces in the order they are numbered. Many are encoded in one text. One of letters alone is
        one word to the tokenizer and ends with the first token that ends a word; else a token
        belongs to the piece it starts in."""
        plain, other = [], []
        for piece in pieces:
            (plain if piece.isalpha() else other).append(piece)
        # nothing changes or splits lower-case ASCII letters, so they can go to the model at once
        found = [[t.id for t in self.tokenizer.model.tokenize(p.decode())] for p in plain]
        self._add(list(chain.from_iterable(found)), np.cumsum([len(f) for f in found], dtype=np.int64))
        done = plain
        letters = [p.decode().isalpha() for p in other]
        accented, other = list(compress(other, letters)), [p for p, ok in zip(other, letters) if not ok]
        for part in (accented[i : i + 2048] for i in range(0, len(accented), 2048)):
            text = b" ".join(part).decode()
            ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
            ends = np.flatnonzero(self.final[ids]) + 1
            if len(ends) == len(part):
                self._add(ids, ends)
                done += part
            else:  # what is a letter depends on the version of Unicode
                other += part
        for part in (other[i : i + 2048] for i in range(0, len(other), 2048)):
            words = [c.decode() for c in part]
            encoding = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
            starts = np.array(encoding.offsets, np.int64).reshape(-1, 2)[:, 0]
            after = np.cumsum([len(w) + 1 for w in words])
            self._add(encoding.ids, np.searchsorted(starts, after))
            done += part
        return done

    def _learn(self, new: list[bytes]) -> np.ndarray:
        """Numbers of the two pieces of each run; pieces are known by a 64-bit hash."""
        split = [part for word in new for part in _core(word)]
        values, index, which = np.unique(
            np.fromiter(map(hash, split), np.int64, len(split)), return_index=True, return_inverse=True
        )
        at = np.searchsorted(self.pieces, values)
        missing = np.flatnonzero(self.pieces[np.minimum(at, len(self.pieces) - 1)] != values)
        if len(missing):
            first = self.n_pieces
            order = self._encode_pieces([split[i] for i in index[missing].tolist()])
            added = np.fromiter(map(hash, order), np.int64, len(order))
            sort = np.argsort(added)
            place = np.searchsorted(self.pieces, added[sort])
            self.pieces = np.insert(self.pieces, place, added[sort])
            self.numbers = np.insert(self.numbers, place, first + sort)
            at = np.searchsorted(self.pieces, values)
        return self.numbers[at][which].reshape(-1, 2)

    def encode(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of each text's ids."""
        if len(self.known) > _KNOWN:
            self._clear()
        data = b" ".join(texts)
        hashes, first, end = tokens(data)
        limits = np.searchsorted(first, np.cumsum([0] + [len(t) + 1 for t in texts]))
        values, index, which = np.unique(hashes, return_index=True, return_inverse=True)
        begin, stop = first[index], end[index]
        codes = np.frombuffer(data, np.uint8)
        check = (stop - begin) << 16 | codes[begin].astype(np.int64) << 8 | codes[stop - 1]
        at = np.minimum(np.searchsorted(self.known, values), len(self.known) - 1)
        same = self.known[at] == values
        parts = self.parts[at]
        new = np.flatnonzero(~same | (self.check[at] != check))
        if len(new):
            parts[new] = self._learn([data[a:b] for a, b in zip(begin[new].tolist(), stop[new].tolist())])
            fresh = new[~same[new]]
            place = np.searchsorted(self.known, values[fresh])
            self.known = np.insert(self.known, place, values[fresh])
            self.check = np.insert(self.check, place, check[fresh])
            self.parts = np.insert(self.parts, place, parts[fresh], axis=0)
        pieces = parts[which].reshape(-1)
        starts = self.ends[pieces].astype(np.int64)
        each = self.ends[pieces + 1] - starts
        edges = np.concatenate([[0], np.cumsum(each)])
        ids = self.flat[np.arange(edges[-1]) + np.repeat(starts - edges[:-1], each)]
        return ids, np.diff(edges[2 * limits])


def _room(held: np.ndarray, size: int) -> np.ndarray:
    """An array at least that long that starts like `held`."""
    if size <= len(held):
        return held
    more = np.zeros((max(size, 2 * len(held)), *held.shape[1:]), held.dtype)
    more[: len(held)] = held
    return more


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    """The encoder of this worker process, which its tasks share one after the other."""
    return WordEncoder(_tokenizer(path))


def with_end(ids: np.ndarray, counts: np.ndarray, end: int = END) -> tuple[np.ndarray, np.ndarray]:
    """The ids with `end` after each document."""
    return np.insert(ids, np.cumsum(counts), end).astype(np.uint32), counts + 1


def write_files(
    docs: DataFrame, tokenizer: str, target: str, doc_id: str = "doc_id", text: str = "text", end: int = END
) -> DataFrame:
    """Encode all texts and write the files below the folder `target`; the stored manifest, one
    row per file: `shard`, `path`, `n_ids`, `n_docs`. Rows of one id are ordered by their
    text's hash; null ids come first; null texts are empty and have the end id alone."""
    rows = docs.select(column(docs, doc_id).cast("bigint").alias("doc_id"), column(docs, text).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        shard = TaskContext.get().partitionId()
        writer, path = None, f"{target}/ids-{shard:06d}-{uuid.uuid4().hex}.bin"
        for batch in batches:
            for start, run in text_slices(batch.column(1), _SLICE):
                if writer is None:
                    store, place = _opened(path)
                    store.create_dir(os.path.dirname(place), recursive=True)
                    writer = Writer(store.open_output_stream(place), bits_for(encoder.tokenizer.get_vocab_size()))
                ids, counts = with_end(*encoder.encode(run), end)
                keys = batch.column(0).slice(start, len(run))
                nulls = keys.is_null().to_numpy(zero_copy_only=False)
                writer.add(keys.fill_null(0).to_numpy(), nulls, counts, ids)
        if writer is not None:
            n_ids, n_docs = writer.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([path]), pa.array([n_ids]), pa.array([n_docs])],
                names=["shard", "path", "n_ids", "n_docs"],
            )

    return stored(rows.mapInArrow(write, MANIFEST), "manifest")


def read_files(manifest: DataFrame) -> DataFrame:
    """Per document, from the files alone: `doc_id`, `start` (ids of all documents before it),
    `n_tokens`, `ids_crc32`. Starts of files are summed over the manifest, a row per file."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    several = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    files = files.select("path", "first", "n_ids").repartition(several, "path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from table(row["path"], row["first"], row["n_ids"])

    def table(path: str, first: int, n_ids: int) -> Iterator[pa.RecordBatch]:
        store, place = _opened(path)
        with store.open_input_file(place) as source:
            reader = Reader(source)
            if reader.n_ids != n_ids:
                raise ValueError(f"{path} has {reader.n_ids} ids, its manifest {n_ids}")
            sums = np.fromiter((crc for _, crc in reader.documents()), np.int64, reader.n_docs)
            for a, b in pairwise([*range(0, reader.n_docs, 1 << 16), reader.n_docs]):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(reader.docs[a:b], pa.int64(), mask=reader.nulls[a:b]),
                        pa.array(reader.starts[a:b] + first),
                        pa.array(reader.lengths[a:b]),
                        pa.array(sums[a:b]),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return files.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_files(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", target: str | None = None) -> DataFrame:
    """Write the files of `docs` and read them back: a row per document (see `read_files`)."""
    target = target or new_path(docs.sparkSession, "ids")
    return read_files(write_files(docs, tokenizer, target, doc_id, text))
