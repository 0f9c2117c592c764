"""Token ids in shard files: one zstandard dictionary for all documents, one compressed frame per document, an offset index.

A shard file holds, one after the other:

- header (64 bytes): ``TOKSHRD1``, SHA-256 of the dictionary (32 bytes, zeros without one), and as little-endian unsigned
  64-bit integers the bytes per id (2 or 4), the number of documents and the offset of the index,
- the frames: each document's ids, little-endian unsigned, compressed by itself,
- the index, a record per document (``INDEX``): doc_id, whether it has one, offset and length of its frame, number of ids.

A document is read by its index record and one frame. The dictionary lies beside the shards as ``<SHA-256>.dict``.
"""

from __future__ import annotations

import hashlib
import os
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelmill.llm.shared import frozen, give_back, hash_sample, only, small_batches
from reelmill.llm.words import gathered, hash_spans, raw, slices, spans
from reelmill.session import fresh_path

MAGIC = b"TOKSHRD1"
HEADER = 64
INDEX = np.dtype([("doc_id", "<i8"), ("has_id", "<u8"), ("offset", "<u8"), ("length", "<u8"), ("n_tokens", "<u8")])
SHARD_BYTES = 8 << 20  # a shard is closed when its frames reach this size
SAMPLE_DOCS = 2000  # about so many documents train the dictionary, those with the smallest hashes
SAMPLE_BYTES = 16 << 10  # of one document's ids in that sample
DICTIONARY_BYTES = 64 << 10
CACHED_WORDS = 1_500_000  # by hash: 24 MB with two ids a word,
CACHED_IDS = 8 << 20  # and at most 16 MB of ids, however long the words are


@dataclass(frozen=True)
class Encoding:
    """Which tokenizer encodes and how its ids are stored."""

    tokenizer: str  # path of its file
    end_id: int | None = None
    # White space has no id, A-Z count as a-z, and letters are split from a comma or full stop behind them: words can be
    # encoded one by one, in lower case, and looked up.
    by_word: bool = False
    level: int = 3


def word_encoding() -> Encoding:
    """The installed lower-case word tokenizer, with id 2 behind each document."""
    import public_tokenizers

    return Encoding(public_tokenizers.path("word_bpe_49k.json"), end_id=2, by_word=True)


_tokenizers: dict[str, tuple] = {}


class WordCache:
    """Ids of words by the hash of the word: sorted hashes, each with a run of the id pool."""

    def __init__(self, kind: np.dtype) -> None:
        self.kind = kind
        self.clear()

    def clear(self) -> None:
        self.hashes, self.starts = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.sizes, self.pool = np.zeros(0, np.uint32), np.zeros(0, self.kind)

    def full(self) -> bool:
        return len(self.hashes) > CACHED_WORDS or len(self.pool) > CACHED_IDS

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hashes and which of them are there."""
        at = np.searchsorted(self.hashes, wanted)
        there = at < len(self.hashes)
        there[there] = self.hashes[at[there]] == wanted[there]
        return at, there

    def add(self, new: np.ndarray, ids: list[list[int]]) -> None:
        """Take in sorted hashes that are not there yet."""
        sizes = np.array([len(x) for x in ids], np.int64)
        starts = len(self.pool) + np.cumsum(sizes) - sizes
        self.pool = np.concatenate([self.pool, np.array([i for x in ids for i in x], self.kind)])
        at = np.searchsorted(self.hashes, new)
        self.hashes = np.insert(self.hashes, at, new)
        self.starts, self.sizes = np.insert(self.starts, at, starts), np.insert(self.sizes, at, sizes)

    def runs(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts in the pool and sizes of the words at these places."""
        return self.starts[at].astype(np.int64), self.sizes[at].astype(np.int64)


def _loaded(path: str):
    """The tokenizer, its id type and the word cache of this Python process."""
    if path not in _tokenizers:
        # A task has one core; the tokenizer's own threads would each keep memory besides.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        top = max(tokenizer.get_vocab(with_added_tokens=True).values(), default=0)
        kind = np.dtype("<u2") if top < 1 << 16 else np.dtype("<u4")
        _tokenizers[path] = (tokenizer, kind, WordCache(kind))
    return _tokenizers[path]


def encode(texts: pa.Array, how: Encoding) -> Iterator[bytes]:
    """The ids of each text as bytes of the stored type. Missing texts are empty."""
    tokenizer, kind, cache = _loaded(how.tokenizer)
    if how.end_id is not None and how.end_id > np.iinfo(kind).max:
        kind = np.dtype("<u4")
    end = [] if how.end_id is None else [how.end_id]

    def ids(batch: list[str]) -> list[list[int]]:
        return [x.ids for x in tokenizer.encode_batch_fast(batch, add_special_tokens=False)]

    specials = [x.content.lower().encode() for x in tokenizer.get_added_tokens_decoder().values()]
    data, offsets = raw(texts)
    for start, stop in slices(texts):
        if not how.by_word:
            for x in ids(texts.slice(start, stop - start).fill_null("").to_pylist()):
                yield np.array(x + end, kind).tobytes()
            continue
        own = offsets[start:stop + 1]
        text = data[own[0]:own[-1]]
        starts, ends, bounds = spans(data, own)
        found, sizes = _by_word(cache, text, starts, ends, ids)
        edges = np.concatenate([[0], np.cumsum(sizes)])[bounds].tolist()
        lower = text.tobytes().lower()
        spelled = any(x in lower for x in specials)
        closing = np.array(end, kind).tobytes()
        for k in range(stop - start):
            # A text that spells a special token is left to the tokenizer.
            if spelled and any(x in lower[own[k] - own[0]:own[k + 1] - own[0]] for x in specials):
                yield np.array(ids([texts[start + k].as_py()])[0] + end, kind).tobytes()
            else:
                yield found[edges[k]:edges[k + 1]].astype(kind, copy=False).tobytes() + closing


def _by_word(cache: WordCache, text: np.ndarray, starts: np.ndarray, ends: np.ndarray,
             ids: Callable[[list[str]], list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words, one after the other, and how many each word has."""
    if cache.full():
        cache.clear()
    words, first, each = np.unique(hash_spans(text, starts, ends, fold=True), return_index=True, return_inverse=True)
    at, there = cache.find(words)
    new = np.flatnonzero(~there)
    if len(new):
        spelled = [text[starts[i]:ends[i]].tobytes().lower() for i in first[new].tolist()]
        cache.add(words[new], _split_ids(spelled, ids))
        at = cache.find(words)[0]
    own, counts = cache.runs(at)
    sizes = counts[each]
    return gathered(cache.pool, own[each], sizes), sizes


def _split_ids(words: list[bytes], ids: Callable[[list[str]], list[list[int]]]) -> list[list[int]]:
    """The ids of each word; what a comma or full stop behind a letter adds is looked up once."""
    cores, tails = [], []
    for word in words:
        core = word.rstrip(b".,")
        whole = not core[-1:].isalpha()
        cores.append(word if whole else core)
        tails.append(b"" if whole else word[len(core):])
    parts = list({*cores, *tails} - {b""})
    known = dict(zip(parts, ids([x.decode() for x in parts]), strict=True))
    return [known[core] + known[tail] if tail else known[core] for core, tail in zip(cores, tails, strict=True)]


def _compressor(dictionary: bytes | None, level: int) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=level, dict_data=_dictionary(dictionary))


def _dictionary(data: bytes | None) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def train_dictionary(docs: DataFrame, how: Encoding, sample: int = SAMPLE_DOCS) -> bytes | None:
    """A dictionary of the id arrays of about ``sample`` documents with the smallest hashes; nothing for an empty table.

    At most ``2 * sample`` times 16 KB reach the driver. The sample decides how small the files are, never what they hold.
    """
    chosen = hash_sample(only(small_batches(docs), {"doc_id": "long", "text": "string"}), sample)

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict(
                {"ids": pa.array([x[:SAMPLE_BYTES] for x in encode(batch.column("text"), how)], pa.binary())})

    samples = [bytes(row.ids) for row in chosen.select("text").mapInArrow(arrays, "ids binary").toLocalIterator() if row.ids]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if samples else None
    except zstandard.ZstdError:  # too little material to train on: the ids themselves serve as content
        return b"".join(samples)[-DICTIONARY_BYTES:]


def write_tokens(docs: DataFrame, how: Encoding, folder: str | None = None, dictionary: bytes | None = None) -> DataFrame:
    """Encode documents (``doc_id``, ``text``) and write them as shards in ascending doc_id order.

    Returns the manifest: ``path``, ``shard`` (its place in the order, from 0), ``n_docs``, ``n_tokens`` and ``start`` (ids
    in the shards before it). Missing texts are empty documents, missing ids come first, repeated rows are written each
    time, an empty table gives no shard; other columns are ignored. Encoded documents are frozen before they are dealt by
    range of doc_id, and shards appear under their final names only when whole, so that a repeated task writes the same
    files again.
    """
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "tokens")
    dictionary = dictionary or train_dictionary(docs, how)
    digest = hashlib.sha256(dictionary).digest() if dictionary else bytes(32)
    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    if dictionary:
        with store.open_output_stream(f"{base}/{digest.hex()}.dict") as out:
            out.write(dictionary)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        pack = _compressor(dictionary, how.level).compress
        width = None
        for batch in batches:
            ids = encode(batch.column("text"), how)
            width = width or (4 if how.end_id and how.end_id >= 1 << 16 else _loaded(how.tokenizer)[1].itemsize)
            at = 0
            for start, stop in slices(batch.column("text")):
                data = [next(ids) for _ in range(stop - start)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(at, len(data)),
                    "n_tokens": pa.array([len(x) // width for x in data], pa.int64()),
                    "width": pa.array([width] * len(data), pa.int32()),
                    "frame": pa.array([pack(x) for x in data], pa.binary()),
                })
                at += len(data)
        give_back()

    rows = only(small_batches(docs), {"doc_id": "long", "text": "string"})
    encoded = frozen(rows.mapInArrow(frames, "doc_id long, n_tokens long, width int, frame binary"), "token-frames")
    parts = max(1, encoded.rdd.getNumPartitions())
    ordered = encoded.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), F.xxhash64("frame")).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.xxhash64("frame")).withColumn("part", F.spark_partition_id())

    manifest = frozen(ordered.mapInArrow(
        _shard_writer(folder, digest), "path string, part int, number int, n_docs long, n_tokens long"), "token-manifest")
    order = Window.orderBy("part", "number")  # a row per shard of some megabytes
    return frozen(manifest.select(
        "path", (F.row_number().over(order) - 1).alias("shard"), "n_docs", "n_tokens",
        (F.sum("n_tokens").over(order) - F.col("n_tokens")).alias("start")), "token-shards")


def _shard_writer(folder: str, digest: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        part = number = size = 0
        frames: list[bytes] = []
        index: list[tuple] = []
        width = 2

        def close() -> pa.RecordBatch:
            name = f"{base}/shard-{part:06d}-{number:06d}.tok"
            draft = f"{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(draft) as out:
                out.write(MAGIC + digest + np.array([width, len(frames), HEADER + size], "<u8").tobytes())
                for frame in frames:
                    out.write(frame)
                out.write(np.array(index, INDEX).tobytes())
            store.move(draft, name)
            return pa.RecordBatch.from_pydict({
                "path": pa.array([f"{folder}/shard-{part:06d}-{number:06d}.tok"]), "part": pa.array([part], pa.int32()),
                "number": pa.array([number], pa.int32()), "n_docs": pa.array([len(frames)], pa.int64()),
                "n_tokens": pa.array([sum(x[4] for x in index)], pa.int64())})

        for batch in batches:
            for row in batch.to_pylist():
                part, width = row["part"], row["width"]
                doc_id, frame = row["doc_id"], row["frame"]
                index.append((doc_id or 0, doc_id is not None, HEADER + size, len(frame), row["n_tokens"]))
                frames.append(frame)
                size += len(frame)
                if size >= SHARD_BYTES:
                    yield close()
                    frames, index, size, number = [], [], 0, number + 1
        if frames:
            yield close()

    return write


SHARDS_PER_TASK = 4  # some megabytes each


class Shard:
    """One shard file, open for reading single documents."""

    def __init__(self, path: str) -> None:
        self.store, name = fs.FileSystem.from_uri(path)
        self.file = self.store.open_input_file(name)
        head = self.file.read(HEADER)
        if head[:8] != MAGIC:
            raise ValueError(f"{path} is no token shard")
        self.digest = head[8:40]
        width, self.n_docs, self.index_at = np.frombuffer(head[40:], "<u8").tolist()
        self.kind = np.dtype(f"<u{width}")
        data = None
        if any(self.digest):
            with self.store.open_input_stream(f"{name.rpartition('/')[0]}/{self.digest.hex()}.dict") as file:
                data = file.read()
            if hashlib.sha256(data).digest() != self.digest:
                raise ValueError(f"the dictionary of {path} has another hash")
        self.unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(data)).decompress
        self.file.seek(self.index_at)
        self.index = np.frombuffer(self.file.read(self.n_docs * INDEX.itemsize), INDEX)

    def ids(self, k: int) -> np.ndarray:
        """The ids of the shard's document number k."""
        record = self.index[k]
        self.file.seek(int(record["offset"]))
        size = int(record["n_tokens"]) * self.kind.itemsize
        frame = self.file.read(int(record["length"]))
        return np.frombuffer(self.unpack(frame, max_output_size=max(size, 1)), self.kind)

    def __enter__(self) -> Shard:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Every document of the shards: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``
    (of the ids as little-endian unsigned 32-bit integers), ``shard`` and ``place`` in it."""
    ddl = "doc_id long, start long, n_tokens long, ids_crc32 long, shard int, place int"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with Shard(row["path"]) as shard:
                    counts, crcs = [], []
                    for k in range(shard.n_docs):
                        ids = shard.ids(k)
                        counts.append(len(ids))
                        crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    starts = row["start"] + np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(shard.index["doc_id"], pa.int64(), mask=shard.index["has_id"] == 0),
                        "start": pa.array(starts), "n_tokens": pa.array(counts, pa.int64()),
                        "ids_crc32": pa.array(crcs, pa.int64()),
                        "shard": pa.array([row["shard"]] * shard.n_docs, pa.int32()),
                        "place": pa.array(range(shard.n_docs), pa.int32())})

    # The manifest is small and what it names is not: the number of tasks comes from the number of shards.
    tasks = max(1, -(-manifest.count() // SHARDS_PER_TASK))
    return manifest.repartitionByRange(tasks, "shard").mapInArrow(read, ddl)
