"""Token id files: one zstandard frame per document, with one dictionary for all of them.

The file format is two Parquet tables, so any store that Spark writes to can hold it:

dictionary  dict_hash, width, dictionary    trained on serialized id arrays of sampled documents
shards      part, shard, dict_hash, start, doc_ids, n_tokens, offsets, blob

A shard's `blob` holds the frames of its documents one after the other; `offsets` says where
each begins, so a short document is read by slicing its frame out and decompressing that alone.
Shards come in ascending order of doc_id over (part, shard); `start` counts the ids of the part
before the shard. Ids are little-endian and take `width` bytes.
"""

from __future__ import annotations

import hashlib
import os
import sys
from array import array
from codecs import charmap_decode
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from linkloom.llm.common import column, text_batches
from linkloom.operators.materialize import materialize

END_ID = 0
DICTIONARY_BYTES = 64 * 1024
# The dictionary is trained on at most so many documents, the smallest by hash of the id, whose
# serialized ids take at most SAMPLE_BYTES each.
SAMPLE_DOCS = 1000
SAMPLE_BYTES = 32 * 1024
LEVEL = 3
SHARD_BYTES = 2 * 1024 * 1024
# Atoms that are kept: how many, and in bytes of theirs and of their ids.
MEMO_ATOMS = 400_000
MEMO_BYTES = 32 * 1024 * 1024
# A blank in a run of white space, or one at the end of a text after white space. White space is
# all that some version of Unicode or Python counts as such.
_SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
_RUN = rf"{_SPACE} ({_SPACE}|\z)"
# A word of Latin letters or ASCII digits after a blank, marks that are neither letter, digit nor
# apostrophe, perhaps a new line, and more of both: each is a piece of its own. Letters below
# 0x250 have been letters in all versions of Unicode that libraries go by.
_LETTERS = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+"
_MARKS = r"[\-.,;:!?|$%&#*()]+"
_WORD = rf"\A ?(?:{_LETTERS}|[0-9]+)\z"
_SHAPE = rf"\A(?P<word> (?:{_LETTERS}|[0-9]+))(?P<mark>{_MARKS})?(?P<line>\n)?(?P<bare>{_LETTERS})?(?P<after>{_MARKS})?\z"
# The letters that byte-level vocabularies write for the 256 bytes: printable ones stand for
# themselves, the others for the letters from 256 on, in order.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHER = [b for b in range(256) if b not in _PLAIN]
_BYTE_LETTERS = "".join(chr(256 + _OTHER.index(b) if b in _OTHER else b) for b in range(256))
# Texts that are encoded together, in bytes; a longer text is encoded on its own.
BATCH_BYTES = 2 * 1024 * 1024

SHARD_SCHEMA = (
    "part int, shard int, dict_hash string, start bigint, doc_ids array<bigint>, "
    "n_tokens array<bigint>, offsets array<bigint>, blob binary"
)


class Encoder:
    """Text to serialized ids with the `tokenizers` library.

    With `by_blank`, for byte-level vocabularies whose pre-tokenizer begins a new piece at a
    blank, texts are cut at their single blanks and every distinct piece encoded once, which gives
    the same ids as the whole text. Only a blank that follows white space, before other white space
    or the end, may belong to a longer run; texts that have one are encoded as a whole, as are
    those that hold one of the vocabulary's added tokens. Pieces are cut further into words and
    marks where they have the plain form of `_SHAPE`. All that, and putting ids together, is done
    on Arrow columns; Python sees an atom only when it is new. Atoms and their ids are kept in two
    columns, which are emptied when long.
    """

    def __init__(self, path: str, by_blank: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = "H" if self.width == 2 else "I"
        self.by_blank = by_blank
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.atoms, self.ids = pa.array([""], pa.large_string()), pa.array([b""], pa.large_binary())

    def _direct(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.kind, e.ids).tobytes() for e in encoded]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of Latin letters or ASCII digits, with a blank before them or without.

        Each is one piece to the pre-tokenizer, so the library's model can be asked directly; to
        it a byte is the letter that byte-level vocabularies write for it.
        """
        kind, tokenize = self.kind, self.tokenizer.model.tokenize
        letters = [charmap_decode(w.encode(), "strict", _BYTE_LETTERS)[0] for w in words]
        return [array(kind, [t.id for t in tokenize(x)]).tobytes() for x in letters]

    def _learn(self, atoms: pa.Array) -> None:
        plain = pc.match_substring_regex(atoms, _WORD)
        words, rest = atoms.filter(plain), atoms.filter(pc.invert(plain))
        ids = self._words(words.to_pylist()) + self._direct(rest.to_pylist())
        self.atoms = pa.concat_arrays([self.atoms, words, rest])
        self.ids = pa.concat_arrays([self.ids, pa.array(ids, pa.large_binary())])

    def _pieces(self, pieces: pa.Array) -> pa.Array:
        """Ids of pieces, each with a blank before it."""
        blanked = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), pieces, pa.scalar("", pa.large_string()))
        shaped = pc.extract_regex(blanked, _SHAPE)
        first, *others = (pc.struct_field(shaped, i) for i in range(shaped.type.num_fields))
        parts = [pc.coalesce(first, blanked), *(pc.fill_null(o, "") for o in others)]
        coded = pa.concat_arrays(parts).dictionary_encode()
        at = pc.index_in(coded.dictionary, value_set=self.atoms)
        if at.null_count:
            self._learn(coded.dictionary.filter(pc.is_null(at)))
            at = pc.index_in(coded.dictionary, value_set=self.atoms)
        ids = self.ids.take(at.take(coded.indices))
        n = len(pieces)
        return pc.binary_join_element_wise(*(ids.slice(i * n, n) for i in range(len(parts))), pa.scalar(b"", pa.large_binary()))

    def _whole(self, texts: pa.Array) -> pa.Array:
        """Which texts may not be cut."""
        if not self.by_blank:
            return pc.is_valid(texts)
        found = pc.match_substring_regex(texts, _RUN)
        for token in self.added:
            found = pc.or_(found, pc.match_substring(texts, token))
        return found

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Serialized ids of each text; those of a null are empty."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        if not len(texts):
            return []
        if len(self.atoms) > MEMO_ATOMS or self.atoms.nbytes + self.ids.nbytes > MEMO_BYTES:
            self._forget()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = self._whole(texts)
        cut = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        bounds, pieces = cut.offsets.to_numpy(), cut.values
        # The first piece of a text has no blank before it; texts that are not cut are their own.
        heads = pc.if_else(whole, texts, pieces.take(pa.array(bounds[:-1]))).to_pylist()
        coded = pieces.dictionary_encode()
        index = coded.indices.to_numpy().astype(np.int64)
        index[bounds[:-1]] = len(coded.dictionary) + np.arange(len(heads))
        known = pa.concat_arrays([self._pieces(coded.dictionary), pa.array(self._direct(heads), pa.large_binary())])
        _, ends, data = known.take(pa.array(index)).buffers()
        ends = np.frombuffer(ends, np.int64, len(index) + 1)[bounds].tolist()
        view = memoryview(data or b"")
        return [bytes(view[a:b]) for a, b in zip(ends, ends[1:])]


def worker_encoder(path: str) -> Encoder:
    """The encoder of this Python worker, which serves one task after the other."""
    kept = sys.modules.setdefault("_worker_encoders", ModuleType("_worker_encoders")).__dict__
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def release_encoders() -> None:
    """Give back the memory of this worker's encoders; the next one who needs them loads them."""
    sys.modules.pop("_worker_encoders", None)
    pa.default_memory_pool().release_unused()


def _sample(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    enc = worker_encoder(path)
    end = end_id.to_bytes(enc.width, "little")
    for batch in batches:
        # A token takes at least one byte of text, so very long texts need not be encoded to be left out.
        texts = [t or "" for t in column(batch, "text") if len(t or "") <= SAMPLE_BYTES * 16]
        ids = [x + end for x in enc.encode(texts) if len(x) < SAMPLE_BYTES]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["ids"])


def train_dictionary(docs: DataFrame, path: str, end_id: int = END_ID) -> tuple[str, bytes]:
    """(hash, bytes) of a dictionary; both empty when there is too little to learn from."""
    chosen = docs.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct()
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text").limit(SAMPLE_DOCS)
    rows = texts.mapInArrow(lambda batches: _sample(batches, path, end_id), "ids binary").collect()
    samples = sorted(bytes(r.ids) for r in rows)
    try:
        data = zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return "", b""
    return hashlib.sha256(data).hexdigest(), data


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches put together up to BATCH_BYTES, so that a new word is met fewer times."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= BATCH_BYTES:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most twice BATCH_BYTES of text, of one row at least.

    Joined batches are a little above BATCH_BYTES, and stay whole.
    """
    lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index("text"))), 0)
    ends, at = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64)), 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = max(int(np.searchsorted(ends, before + 2 * BATCH_BYTES, "right")), at + 1)
        yield batch.slice(at, end - at)
        at = end


def _frames(batches: Iterator[pa.RecordBatch], path: str, dictionary: bytes, end_id: int) -> Iterator[pa.RecordBatch]:
    # Arrow keeps what it has freed; what other work has left in this worker is given back first.
    pa.default_memory_pool().release_unused()
    enc = worker_encoder(path)
    end = end_id.to_bytes(enc.width, "little")
    compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary)).compress
    for whole in _joined(batches):
        for batch in _slices(whole):
            counts, frames = [], []
            for ids in enc.encode(batch.column(batch.schema.get_field_index("text"))):
                counts.append((len(ids) + len(end)) // enc.width)
                frames.append(compress(ids + end))
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(frames, pa.binary())],
                ["doc_id", "n_tokens", "frame"],
            )
    pa.default_memory_pool().release_unused()


def _pack(batches: Iterator[pa.RecordBatch], dict_hash: str) -> Iterator[pa.RecordBatch]:
    """Sorted frames of one task to shards of about SHARD_BYTES."""
    longs = pa.list_(pa.int64())
    schema = pa.schema(
        [("part", pa.int32()), ("shard", pa.int32()), ("dict_hash", pa.string()), ("start", pa.int64())]
        + [(name, longs) for name in ("doc_ids", "n_tokens", "offsets")]
        + [("blob", pa.binary())]
    )
    release_encoders()
    part, shard, start, total = TaskContext.get().partitionId(), 0, 0, 0
    ids, counts, offsets, frames, size = [], [], [], [], 0

    def flush() -> pa.RecordBatch:
        row = [part, shard, dict_hash, start, ids, counts, offsets, b"".join(frames)]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

    for batch in batches:
        for doc_id, n, frame in zip(column(batch, "doc_id"), column(batch, "n_tokens"), column(batch, "frame")):
            ids.append(doc_id)
            counts.append(n)
            offsets.append(size)
            frames.append(frame)
            size += len(frame)
            total += n
            if size >= SHARD_BYTES:
                yield flush()
                ids, counts, offsets, frames, size = [], [], [], [], 0
                shard, start = shard + 1, total
    if ids:
        yield flush()


def write_token_files(docs: DataFrame, path: str, end_id: int = END_ID) -> tuple[DataFrame, DataFrame]:
    """Encode (doc_id, text) and write the two tables: (dictionary, shards).

    One frame per input row: repeated rows are written again, a null text is an empty one (its
    frame holds the end id alone), null ids come first. Rows of equal id stand in the order of
    their frames. Frames are written once before they are sorted, so a lost executor costs no
    second encoding, and what is shuffled is compressed. No columns but doc_id and text are read.
    """
    spark = docs.sparkSession
    text_batches(spark)
    dict_hash, dictionary = train_dictionary(docs, path, end_id)
    width = Encoder(path).width
    table = materialize(
        spark.createDataFrame([(dict_hash, width, bytearray(dictionary))], "dict_hash string, width int, dictionary binary"),
        "token-dictionary",
    )
    frames = docs.select("doc_id", "text").mapInArrow(
        lambda batches: _frames(batches, path, dictionary, end_id), "doc_id bigint, n_tokens bigint, frame binary"
    )
    frames = materialize(frames, "token-frames")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("frame").asc()]
    ordered = frames.repartitionByRange(*order).sortWithinPartitions(*order)
    shards = ordered.mapInArrow(lambda batches: _pack(batches, dict_hash), SHARD_SCHEMA)
    return table, materialize(shards, "token-shards")


def _read(batches: Iterator[pa.RecordBatch], dictionary: bytes, width: int) -> Iterator[pa.RecordBatch]:
    release_encoders()
    decompress = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary)).decompress
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])
    for batch in batches:
        for start, doc_ids, counts, offsets, blob in zip(
            *(column(batch, c) for c in ("start", "doc_ids", "n_tokens", "offsets", "blob"))
        ):
            view, bounds = memoryview(blob), [*offsets, len(blob)]
            firsts = np.concatenate(([0], np.cumsum(counts)[:-1])).astype(np.int64) + start
            for at in range(0, len(doc_ids), 512):
                some = range(at, min(at + 512, len(doc_ids)))
                ids = [decompress(view[bounds[i] : bounds[i + 1]]) for i in some]
                if width == 2:
                    ids = [np.frombuffer(x, "<u2").astype("<u4").tobytes() for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids[at : at + 512], pa.int64()), pa.array(firsts[at : at + 512]), pa.array(ids, pa.binary())],
                    schema=schema,
                )


def open_dictionary(dictionary: DataFrame, shards: DataFrame) -> tuple[bytes, int]:
    """The dictionary's bytes and the width of an id, after comparing hashes."""
    (dict_hash, width, data) = dictionary.first()
    if data and hashlib.sha256(data).hexdigest() != dict_hash:
        raise ValueError("the dictionary does not have the hash it is stored under")
    if not shards.filter(F.col("dict_hash") != dict_hash).isEmpty():
        raise ValueError("some shards were written with another dictionary")
    return bytes(data), width


def read_token_files(dictionary: DataFrame, shards: DataFrame) -> DataFrame:
    """(part, doc_id, start, ids) from the files; `ids` are unsigned 32-bit little-endian.

    `start` counts the ids of all documents before. The totals of the parts are one row per task
    that wrote shards, which are summed up in one small window.
    """
    data, width = open_dictionary(dictionary, shards)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ids_in = F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda a, n: a + n)
    parts = shards.groupBy("part").agg(F.sum(ids_in).alias("n"))
    bases = {r.part: r.base for r in parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")).collect()}

    def read(batches):
        def placed(batches):
            for batch in batches:
                names = batch.schema.names
                base = [s + bases[p] for s, p in zip(column(batch, "start"), column(batch, "part"))]
                yield batch.set_column(names.index("start"), "start", pa.array(base, pa.int64()))

        return _read(placed(batches), data, width)

    return shards.mapInArrow(read, "doc_id bigint, start bigint, ids binary")


def read_documents(dictionary: DataFrame, shards: DataFrame, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of some documents: only their own frames are decompressed."""
    data, width = open_dictionary(dictionary, shards)
    wanted = set(doc_ids)
    holds = F.arrays_overlap("doc_ids", F.array(*[F.lit(i).cast("bigint") for i in doc_ids]))

    def read(batches):
        decompress = zstandard.ZstdDecompressor(dict_data=_dictionary(data)).decompress
        for batch in batches:
            for ids, offsets, blob in zip(*(column(batch, c) for c in ("doc_ids", "offsets", "blob"))):
                bounds = [*offsets, len(blob)]
                found = [(d, decompress(blob[bounds[i] : bounds[i + 1]])) for i, d in enumerate(ids) if d in wanted]
                out = [np.frombuffer(x, f"<u{width}").astype("<u4").tobytes() for _, x in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d for d, _ in found], pa.int64()), pa.array(out, pa.binary())], ["doc_id", "ids"]
                )

    return shards.filter(holds).mapInArrow(read, "doc_id bigint, ids binary")


def checksums(ids: DataFrame) -> DataFrame:
    """(doc_id, start, ids) to (doc_id, start, n_tokens, ids_crc32)."""
    return ids.select("doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
