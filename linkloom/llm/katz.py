"""Katz backoff bigrams: Good-Turing discounted counts, exactly normalised backoff weights.

    P(w | h) = d(r) * r / (c(h) + E)   if the bigram was seen r > 0 times
             = a(h) * P(w)             if not, with a(h) so that all P(. | h) add up to 1
    P(w)     = d(r) * r / N            if w was seen, else what the discounts leave over,
                                       for all unknown words together

c(h) counts h as a context; a context never seen leaves P(w). E is a small constant that keeps
some mass for unseen words after a context whose counts are all too large to be discounted.

`learn` counts and writes the model: the training bigrams with their counts, in buckets of the word,
and the backoff weights, in buckets of the context. `apply` scores any documents, known or new, with
the stored tables alone; `save` and `open_model` keep them beyond a session.

The logarithm of a document's probability is a sum over its tokens, and each of its terms needs
facts about one word, one bigram or one context. So texts never move: every task cuts its
documents into blocks, numbers a block's documents, and sends each bucket of words the bigrams
that end in them, with the numbers of the documents they are in. There they meet the stored
counts, which gives a sum per document. Bigrams that are not stored go on to the buckets of their
contexts and back off there by the stored weights. Words that fill more than a part of a bucket
are split by their contexts, their counts being known to all tasks. All of it travels as packed
arrays, several bytes a bigram.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.common import column, release_shuffles
from linkloom.operators.materialize import materialize

# Counts up to this are discounted.
DISCOUNTED = 5
E = 0.01
BLOCK_TOKENS = 1_800_000
BLOCK_DOCS = 1 << 16
PIECE_DOCS = 1 << 12
BUCKET_TOKENS = 1_000_000
# Blocks' rows of a bucket are unpacked so many bytes at a time.
SLICE_BYTES = 4 << 20
# Texts are scored in so many passes, each for its share of the buckets. More passes read more and
# need less room for shuffled data at a time.
PASSES = 3
# Unseen bigrams of a frequent context are dealt to so many buckets.
SALTS = 16
# Words are known by 64 bits of hash, as contexts by 48 of them.
CONTEXT_BITS = np.uint64((1 << 48) - 1)
END, BEGIN = 1, 2

PACKED = "kind string, bucket int, block bigint, data array<binary>"


# Texts are hashed so many bytes at a time.
PIECE_BYTES = 1 << 19
BASE = 0x9E3779B97F4A7C15
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


class Tables:
    """What `_hashed_words` looks up: blanks, a number for each byte, powers of BASE and of its inverse."""

    def __init__(self):
        self.blank = np.zeros(256, bool)
        self.blank[[0x20, *range(0x09, 0x0E)]] = True
        self.number = np.array([xxhash.xxh64_intdigest(bytes([b])) for b in range(256)], np.uint64)
        self.power = self.inverse = np.empty(0, np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.power):
            self.power, self.inverse = (
                np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, x, np.uint64)]))
                for x in (BASE, pow(BASE, -1, 1 << 64))
            )
        return self.power[:n], self.inverse


def _hashed_words(data: bytes, tables: Tables) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of each word of a byte string that ends in a blank.

    A word's hash is a polynomial in BASE with its bytes' numbers, a difference of running sums, and
    its length, mixed.
    """
    codes = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(codes) + 1, bool)
    inside[1:] = ~tables.blank[codes]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    power, inverse = tables.powers(len(codes))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(tables.number[codes] * power, out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33)), starts


def token_hashes(texts: list[bytes], tables: Tables) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words of texts, END after each text; tokens of each text, with its end)."""
    data = b" ".join(texts) + b" "
    hashes, places, at = [], [], 0
    while at < len(data):
        # A piece ends after a blank, and so does the last one.
        end = len(data) if at + PIECE_BYTES >= len(data) else _BLANK.search(data, at + PIECE_BYTES).end()
        h, starts = _hashed_words(data[at:end], tables)
        hashes.append(h)
        places.append(starts + at)
        at = end
    ends = np.cumsum([len(t) + 1 for t in texts])
    n = np.diff(np.searchsorted(np.concatenate(places), ends), prepend=0)
    out = np.full(n.sum() + len(texts), END, np.uint64)
    out[np.arange(n.sum()) + np.repeat(np.arange(len(texts)), n)] = np.concatenate(hashes)
    return out, n + 1


def word_hashes(words: list[bytes]) -> np.ndarray:
    """Hashes of single words."""
    return token_hashes(words, Tables())[0][::2]


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(ids, hashes, lengths) of some documents at a time."""
    tables, ids, texts, size = Tables(), [], [], 0
    for batch in batches:
        named = batch.schema.get_field_index("doc_id") >= 0
        for doc_id, text in zip(column(batch, "doc_id") if named else [None] * batch.num_rows, column(batch, "text")):
            ids.append(doc_id)
            texts.append((text or "").encode("utf-8", "surrogatepass").lower())
            size += len(texts[-1]) + 1
            if size >= min(PIECE_BYTES, BLOCK_TOKENS) or len(ids) >= PIECE_DOCS:
                yield ids, *token_hashes(texts, tables)
                ids, texts, size = [], [], 0
    if ids:
        yield ids, *token_hashes(texts, tables)


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([("kind", pa.string()), ("bucket", pa.int32()), ("block", pa.int64()), ("data", pa.list_(pa.binary()))])
    columns = list(zip(*rows)) if rows else [()] * 4
    data = [[a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes() for a in d] for d in columns[3]]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array(data, schema.field(3).type)],
        schema=schema,
    )


def _table(batch: pa.RecordBatch) -> pa.Table:
    return pa.Table.from_batches([batch])


def _read(data: list[bytes], *kinds: str) -> list[np.ndarray]:
    return [np.frombuffer(d, k) for d, k in zip(data, kinds)]


def unigram_counts(docs: DataFrame) -> DataFrame:
    """(text) to the written table (word, n), the end of each text counted as a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0

        def flush() -> pa.RecordBatch:
            words, counts = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts.astype(np.int64))], ["word", "n"])

        for _, hashes, _ in _tokens(batches):
            parts.append(hashes)
            size += len(hashes)
            if size >= BLOCK_TOKENS:
                yield flush()
                parts, size = [], 0
        if parts:
            yield flush()

    found = docs.select("text").mapInArrow(run, "word bigint, n bigint")
    return materialize(found.groupBy("word").agg(F.sum("n").alias("n")), "unigrams")


def discounts(counts: list[int]) -> list[float]:
    """Katz's d(1..DISCOUNTED) from the numbers of things seen once, twice, ... times.

    The largest range of counts for which Good-Turing gives factors between 0 and 1 is
    discounted. Where not even one does, what was seen once counts half.
    """
    for k in range(DISCOUNTED, 0, -1):
        n = counts[: k + 1]
        if any(not x for x in n):
            continue
        common = (k + 1) * n[k] / n[0]
        if common >= 1:
            continue
        found = [((r + 1) * n[r] / (r * n[r - 1]) - common) / (1 - common) for r in range(1, k + 1)]
        if all(0 < d < 1 for d in found):
            return found + [1.0] * (DISCOUNTED - k)
    return [0.5] + [1.0] * (DISCOUNTED - 1)


class Unigrams:
    """P(w) from a count, and what all unknown words share."""

    def __init__(self, total: int, distinct: int, counts: list[int]):
        self.total, self.distinct = total, distinct
        self.factors = np.array([1.0, *discounts(counts)])
        kept = total - sum((1 - d) * r * n for r, (d, n) in enumerate(zip(self.factors[1:], counts), start=1))
        # Without words seen once, or any, the unknown ones get the place of one token.
        self.mass = total if kept < total else total + 1
        self.unknown = 1.0 - kept / self.mass

    def probability(self, n: np.ndarray) -> np.ndarray:
        factor = np.where(n <= DISCOUNTED, self.factors[np.minimum(n, DISCOUNTED)], 1.0)
        return np.where(n > 0, factor * n / self.mass, self.unknown)

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + 0.5) / (self.total + 0.5 * (self.distinct + 1)))


def _mixed(words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """One hash for a word and a context."""
    mixed = (words ^ (contexts * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(29))


def _cut(batches: Iterator[pa.RecordBatch], packed: Callable[..., pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in blocks: what `packed` makes of (number of the block, hashes of its tokens,
    documents' lengths, ids). Nothing of a block is left when the next one begins."""
    seq, tokens, lengths, ids, size = 0, [], [], [], 0
    for some, hashes, n in _tokens(batches):
        ids += some
        tokens.append(hashes)
        lengths.append(n)
        size += len(hashes)
        if size >= BLOCK_TOKENS or len(ids) + PIECE_DOCS >= BLOCK_DOCS:
            hashes = some = n = None
            yield packed(seq, tokens, np.concatenate(lengths).astype(np.int64), ids)
            pa.default_memory_pool().release_unused()
            seq, tokens, lengths, ids, size = seq + 1, [], [], [], 0
    if ids:
        yield packed(seq, tokens, np.concatenate(lengths).astype(np.int64), ids)


def _pairs(tokens: list[np.ndarray], lengths: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words, by bucket; per token one number that tells word and context). The last
    context is the beginning of a text."""
    hashes, word = np.unique(np.concatenate(tokens), return_inverse=True)
    by_bucket = np.argsort(hashes % np.uint64(buckets), kind="stable")
    rank = np.empty(len(hashes), np.int64)
    rank[by_bucket] = np.arange(len(hashes))
    word = rank[word]
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[np.cumsum(lengths) - lengths] = len(hashes)
    word *= len(hashes) + 1
    word += before
    return hashes[by_bucket], word


def _dealt(hashes: np.ndarray, pair: np.ndarray, buckets: int, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """(word, context, order by bucket, where each bucket begins) of distinct bigrams."""
    contexts = np.append(hashes & CONTEXT_BITS, np.uint64(BEGIN))[pair % (len(hashes) + 1)]
    word = pair // (len(hashes) + 1)
    bucket = (hashes[word] % np.uint64(buckets)).astype(np.int64)
    split = np.isin(hashes[word], hot)
    bucket[split] = (_mixed(hashes[word][split], contexts[split]) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return word, contexts, order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _pack_contexts(contexts: np.ndarray) -> np.ndarray:
    return contexts.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]


def _bigrams(batches: Iterator[pa.RecordBatch], buckets: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Training documents to rows for the buckets: a block's distinct bigrams and their counts."""

    def packed(seq: int, tokens: list[np.ndarray], lengths: np.ndarray, ids: list) -> pa.RecordBatch:
        hashes, pair = _pairs(tokens, lengths, buckets)
        pair, n = np.unique(pair, return_counts=True)
        word, contexts, order, bounds = _dealt(hashes, pair, buckets, hot)
        rows = []
        for b in range(buckets):
            mine = order[bounds[b] : bounds[b + 1]]
            if len(mine):
                own, runs = np.unique(word[mine], return_counts=True)
                data = [hashes[own].astype("<u8"), runs.astype("<u4"), _pack_contexts(contexts[mine]), n[mine].astype("<u4")]
                rows.append(("bigrams", b, None, data))
        return _packed(rows)

    return _cut(batches, packed)


def _blocks(
    batches: Iterator[pa.RecordBatch], buckets: int, hot: np.ndarray, turn: int, turns: int
) -> Iterator[pa.RecordBatch]:
    """Documents to rows for the buckets of one pass; in the first, a row that lists a block's
    documents. Blocks and numbers are the same in every pass, as the rows of a task are."""
    part = TaskContext.get().partitionId()

    def packed(seq: int, tokens: list[np.ndarray], lengths: np.ndarray, ids: list) -> pa.RecordBatch:
        block = (part << 20) + seq
        hashes, key = _pairs(tokens, lengths, buckets)
        # One number tells word, context and document: the more of one, the fewer of the other.
        bits = len(ids).bit_length()
        key <<= bits
        key |= np.repeat(np.arange(len(ids)), lengths)
        key, n = np.unique(key, return_counts=True)
        pair, first, in_docs = np.unique(key >> bits, return_index=True, return_counts=True)
        word, contexts, order, bounds = _dealt(hashes, pair, buckets, hot)
        rows = []
        if not turn:
            listed = [np.array([-1 if i is None else i for i in ids], "<i8"), lengths.astype("<i8"), bytes([i is None for i in ids])]
            rows.append(("docs", block % buckets, block, listed))
        for b in range(turn, buckets, turns):
            mine = order[bounds[b] : bounds[b + 1]]
            if not len(mine):
                continue
            own, runs = np.unique(word[mine], return_counts=True)
            at = np.repeat(first[mine] - np.cumsum(in_docs[mine]) + in_docs[mine], in_docs[mine]) + np.arange(in_docs[mine].sum())
            data = [
                hashes[own].astype("<u8"),
                runs.astype("<u4"),
                _pack_contexts(contexts[mine]),
                in_docs[mine].astype("<u2"),
                (key[at] & ((1 << bits) - 1)).astype("<u2"),
                n[at].astype("<u4"),
            ]
            rows.append(("bigrams", b, block, data))
        return _packed(rows)

    return _cut(batches, packed)


def _slices(table: pa.Table) -> Iterator[list[dict]]:
    """The rows of a bucket, some SLICE_BYTES at a time, at least one row."""
    some = max(1, table.num_rows * SLICE_BYTES // max(1, table.nbytes))
    for start in range(0, table.num_rows, some):
        yield table.slice(start, some).to_pylist()


def _unpack_contexts(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view("<u8")[:, 0]


def _context_buckets(buckets: int, hot: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first bucket, number of buckets) of each context: those that are frequent words, and the
    beginning of texts, have up to SALTS buckets in a row."""
    first = (_mixed(np.uint64(7), contexts) % np.uint64(buckets)).astype(np.int64)
    frequent = np.isin(contexts, np.append(hot & CONTEXT_BITS, np.uint64(BEGIN)))
    return first, np.where(frequent, min(SALTS, buckets), 1)


def _by_context(kind: str, buckets: int, hot: np.ndarray, contexts: np.ndarray, *columns: np.ndarray) -> list[tuple]:
    """Rows of packed arrays, one for each bucket of contexts. What is known of a context goes to all
    its buckets, its unseen bigrams to one of them by their document (the first of the columns)."""
    bucket, salts = _context_buckets(buckets, hot, contexts)
    if kind == "unseen":
        bucket = (bucket + columns[0] % salts) % buckets
    else:
        of = np.repeat(np.arange(len(contexts)), salts)
        turn = np.arange(len(of)) - np.repeat(np.cumsum(salts) - salts, salts)
        bucket, contexts, columns = (bucket[of] + turn) % buckets, contexts[of], [c[of] for c in columns]
    order = np.argsort(bucket, kind="stable")
    bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
    out = []
    for b in np.unique(bucket).tolist():
        some = order[bounds[b] : bounds[b + 1]]
        out.append((kind, b, None, [contexts[some], *(c[some] for c in columns)]))
    return out


def _found(keys: np.ndarray, values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Values of the asked keys, 0 for those that are not there. `keys` are sorted."""
    if not len(keys):
        return np.zeros(len(asked), values.dtype)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], 0)


def _count(table: pa.Table, buckets: int, unigrams: Unigrams, hot: np.ndarray, hot_n: np.ndarray) -> pa.Table:
    """One bucket of words: the training bigrams with their counts, and what each gives its context."""
    rows = table.column("data").to_pylist()
    bucket = table.column("bucket")[0].as_py()
    columns = [(*_read(d, "<u8", "<u4"), _unpack_contexts(d[2]), np.frombuffer(d[3], "<u4")) for d in rows]
    words = np.concatenate([np.repeat(own, runs) for own, runs, *_ in columns])
    contexts = np.concatenate([c[2] for c in columns])
    n = np.concatenate([c[3] for c in columns])
    del rows, columns, table
    _, first, pair = np.unique(_mixed(words, contexts), return_index=True, return_inverse=True)
    n = np.bincount(pair, n, len(first)).astype(np.int64)
    words, contexts = words[first], contexts[first]
    del first, pair
    order = np.argsort(words, kind="stable")
    words, contexts, n = words[order], contexts[order], n[order]
    own, starts, runs = np.unique(words, return_index=True, return_counts=True)
    n_word = np.add.reduceat(n, starts)
    # A word that is split has its other bigrams elsewhere; its count is known.
    n_word = np.maximum(n_word, _found(hot, hot_n, own))
    out = [("counts", bucket, None, [own, n_word.astype("<i8"), runs.astype("<u4"), _pack_contexts(contexts), n.astype("<i8")])]
    named, at = np.unique(contexts, return_inverse=True)
    mass = np.bincount(at, np.repeat(unigrams.probability(n_word), runs), len(named))
    total = np.bincount(at, n, len(named)).astype("<u8")
    low = np.stack([np.bincount(at, n == r, len(named)) for r in range(1, DISCOUNTED + 1)], axis=1).astype("<u4")
    out += _by_context("contexts", buckets, hot, named, total, low, mass)
    times = np.bincount(np.minimum(n, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1 : DISCOUNTED + 2]
    out.append(("stats", bucket, None, [times.astype("<i8")]))
    return _table(_packed(out))


def _back_off(table: pa.Table, factors: np.ndarray) -> pa.Table:
    """One bucket of contexts: their backoff weights and totals."""
    columns = [_read(d, "<u8", "<i8", "<u4", "<f8") for d in table.column("data").to_pylist()]
    contexts, total, low, mass = (np.concatenate(c) for c in zip(*columns))
    named, at = np.unique(contexts, return_inverse=True)
    total = np.bincount(at, total, len(named))
    low = low.reshape(-1, DISCOUNTED)
    freed = sum(np.bincount(at, low[:, r] * (1 - factors[r]) * (r + 1), len(named)) for r in range(DISCOUNTED))
    left = 1.0 - np.bincount(at, mass, len(named))
    weight = (freed + E) / (total + E) / left
    return _table(_packed([("backoff", table.column("bucket")[0].as_py(), None, [named, weight, total])]))


def _score_words(
    table: pa.Table, stored: pa.Table, buckets: int, unigrams: Unigrams, hot: np.ndarray, hot_n: np.ndarray, factors: np.ndarray
) -> pa.Table:
    """One bucket of words: documents' bigrams meet the stored counts. A row of sums per block, and
    the bigrams that are not stored, for the buckets of their contexts."""
    out, late = [], []
    keys, n_keys = np.empty(0, np.uint64), np.empty(0, np.int64)
    own, n_own = np.empty(0, np.uint64), np.empty(0, np.int64)
    for data in stored.column("data").to_pylist():
        own, n_own, runs, n_keys = _read([*data[:3], data[4]], "<u8", "<i8", "<u4", "<i8")
        keys = _mixed(np.repeat(own, runs), _unpack_contexts(data[3]))
        order = np.argsort(keys)
        keys, n_keys = keys[order], n_keys[order]
    each_factor = np.append(1.0, factors)
    for rows in _slices(table):
        out += [("docs", r["bucket"], r["block"], r["data"]) for r in rows if r["kind"] == "docs"]
        rows = [r for r in rows if r["kind"] == "bigrams"]
        if not rows:
            continue
        bucket = rows[0]["bucket"]
        words = np.concatenate([np.repeat(*_read(r["data"], "<u8", "<u4")) for r in rows])
        contexts = np.concatenate([_unpack_contexts(r["data"][2]) for r in rows])
        in_docs = np.concatenate([np.frombuffer(r["data"][3], "<u2") for r in rows])
        docs = np.concatenate([(r["block"] << 16) + np.frombuffer(r["data"][4], "<u2").astype(np.int64) for r in rows])
        counts = np.concatenate([np.frombuffer(r["data"][5], "<u4").astype(np.int32) for r in rows])
        n_pair = _found(keys, n_keys, _mixed(words, contexts))
        n_word = np.maximum(_found(own, n_own, words), _found(hot, hot_n, words))
        factor = each_factor[np.minimum(n_pair, DISCOUNTED)]
        factor[n_pair > DISCOUNTED] = 1.0
        # Per occurrence: the bigram's part of the score, and the word's as the context of the next.
        each = np.where(n_pair > 0, np.log10(factor * np.maximum(n_pair, 1)), np.log10(unigrams.probability(n_word)))
        each -= np.where((n_word > 0) & (words != END), np.log10(n_word + E), 0.0)
        # Only documents with a word in this bucket are numbered, so that it grows with its words alone.
        # All that a bucket has of a block is in one row.
        present, at_doc = np.unique(docs, return_inverse=True)
        n_docs = len(present)
        score = np.bincount(at_doc, counts * np.repeat(each, in_docs), n_docs)
        plain = np.bincount(at_doc, counts * np.repeat(unigrams.base(n_word), in_docs), n_docs)
        known = np.bincount(at_doc, counts * np.repeat(n_word > 0, in_docs), n_docs)
        # References are in order, so those of a block are next to each other.
        blocks, starts = np.unique(present >> 16, return_index=True)
        for block, start, end in zip(blocks.tolist(), starts.tolist(), [*starts[1:].tolist(), n_docs]):
            part = slice(start, end)
            out.append(("sums", bucket, block, [(present[part] & 0xFFFF).astype("<u2"), plain[part], score[part], known[part].astype("<u4")]))
        unseen = np.repeat(n_pair == 0, in_docs)
        late.append((np.repeat(contexts, in_docs)[unseen], docs[unseen], counts[unseen].astype("<u4")))
    if late:
        out += _by_context("unseen", buckets, hot, *map(np.concatenate, zip(*late)))
    return _table(_packed(out))


def _score_unseen(table: pa.Table, stored: pa.Table) -> pa.Table:
    """One bucket of contexts: what the stored weights add for bigrams that are not stored."""
    out = []
    weights = [_read(d, "<u8", "<f8", "<f8") for d in stored.column("data").to_pylist()]
    if weights and table.num_rows:
        ((named, weight, total),) = weights
        gives = np.log10(weight) + np.log10(total + E)
        references, parts = [], []
        for rows in _slices(table):
            contexts, reference, n = (np.concatenate(c) for c in zip(*(_read(r["data"], "<u8", "<i8", "<u4") for r in rows)))
            # The context was subtracted as if the bigram were seen; that is taken back. A context that was
            # never seen gave nothing, and leaves the word's own probability.
            doc, at_doc = np.unique(reference, return_inverse=True)
            references.append(doc)
            parts.append(np.bincount(at_doc, n * _found(named, gives, contexts), len(doc)))
        doc, at_doc = np.unique(np.concatenate(references), return_inverse=True)
        sums = np.bincount(at_doc, np.concatenate(parts), len(doc))
        block = doc >> 16
        blocks, starts = np.unique(block, return_index=True)
        for b, start, end in zip(blocks.tolist(), starts.tolist(), [*starts[1:].tolist(), len(doc)]):
            out.append(("late", table.column("bucket")[0].as_py(), b, [(doc[start:end] & 0xFFFF).astype("<u2"), sums[start:end]]))
    return _table(_packed(out))


def _documents(table: pa.Table, begin: float) -> pa.Table:
    """One block: its documents with the sums of all buckets."""
    rows = table.to_pylist()
    ids, lengths, none = _read(next(r["data"] for r in rows if r["kind"] == "docs"), "<i8", "<i8", "u1")
    plain, score, known = np.zeros(len(ids)), np.full(len(ids), -begin), np.zeros(len(ids), np.int64)
    for r in sorted((r for r in rows if r["kind"] != "docs"), key=lambda r: (r["kind"], r["bucket"])):
        # A document is in a row once.
        if r["kind"] == "sums":
            at, p, s, k = _read(r["data"], "<u2", "<f8", "<f8", "<u4")
            plain[at] += p
            known[at] += k
            score[at] += s
        else:
            at, more = _read(r["data"], "<u2", "<f8")
            score[at] += more
    doc_id = pa.array([None if gone else int(i) for i, gone in zip(ids, none)], pa.int64())
    columns = [doc_id, pa.array(lengths), pa.array(known), pa.array(plain), pa.array(score)]
    return pa.Table.from_arrays(columns, ["doc_id", "n_tokens", "n_known", "base_score", "score"])


@dataclass
class Model:
    """What was learned. `counts` holds the training bigrams and their counts, a row for each bucket of
    words; `backoff` the weights and totals, a row for each bucket of contexts. `hot` words, at most
    four for each bucket, are split by context."""

    buckets: int
    n_docs: int
    total: int
    distinct: int
    times: list[int]
    factors: list[float]
    hot: np.ndarray
    hot_n: np.ndarray
    counts: DataFrame
    backoff: DataFrame

    @property
    def unigrams(self) -> Unigrams:
        return Unigrams(self.total, self.distinct, self.times)


def learn(docs: DataFrame, scored_bytes: int = 0) -> Model:
    """(text) to a model of all texts. `scored_bytes` is how much text will be scored at a time, where
    that is more than is learned from: there are buckets for that much."""
    docs = docs.select(F.lit(None).cast("bigint").alias("doc_id"), "text")
    words = unigram_counts(docs)
    levels = [F.count_if(F.col("n") == r) for r in range(1, DISCOUNTED + 2)]
    n_docs, total, distinct, *times = words.agg(
        F.coalesce(F.sum(F.when(F.col("word") == END, F.col("n"))), F.lit(0)),
        F.coalesce(F.sum("n"), F.lit(0)),
        F.count("*"),
        *levels,
    ).first()
    buckets = max(8, math.ceil(max(total, scored_bytes / 8) / BUCKET_TOKENS))
    # At most four times as many words as buckets can be that frequent.
    frequent = words.filter(F.col("n") > max(1000, total // (4 * buckets))).collect()
    hot = np.array([r.word for r in frequent], np.int64).view(np.uint64)
    order = np.argsort(hot)
    hot, hot_n = hot[order], np.array([r.n for r in frequent], np.int64)[order]
    unigrams = Unigrams(total, distinct, times)
    counted = docs.mapInArrow(lambda batches: _bigrams(batches, buckets, hot), PACKED).groupBy("bucket")
    counted = materialize(counted.applyInArrow(lambda t: _count(t, buckets, unigrams, hot, hot_n), PACKED), "katz-counts", partition_by="kind", codec="zstd")
    release_shuffles(docs.sparkSession)
    stats = np.zeros(DISCOUNTED + 1, np.int64)
    for r in counted.filter("kind = 'stats'").select("data").toLocalIterator():
        stats += np.frombuffer(r.data[0], "<i8")
    factors = np.array(discounts(stats.tolist()))
    backoff = counted.filter("kind = 'contexts'").groupBy("bucket").applyInArrow(lambda t: _back_off(t, factors), PACKED)
    backoff = materialize(backoff, "katz-backoff", codec="zstd")
    release_shuffles(docs.sparkSession)
    return Model(buckets, n_docs, total, distinct, times, factors.tolist(), hot, hot_n, counted.filter("kind = 'counts'"), backoff)


def apply(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text) to (doc_id, n_tokens, n_known, base_score, score), one row per row of `docs`.

    `score` is the model's log10 probability of the text with its end, `base_score` that of unigrams
    with half a count added. A null or empty text is its end alone. Repeated rows and null ids are
    rows of their own; other columns are not read. Without anything learned, every token is unknown.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    buckets, hot, hot_n, unigrams, factors = model.buckets, model.hot, model.hot_n, model.unigrams, np.array(model.factors)
    met = None
    for turn in range(PASSES):
        sent = docs.mapInArrow(lambda batches, turn=turn: _blocks(batches, buckets, hot, turn, PASSES), PACKED)
        stored = model.counts.filter(F.pmod("bucket", F.lit(PASSES)) == turn)
        part = sent.groupBy("bucket").cogroup(stored.groupBy("bucket"))
        part = part.applyInArrow(lambda t, m: _score_words(t, m, buckets, unigrams, hot, hot_n, factors), PACKED)
        part = materialize(part, "katz-sums", partition_by="kind", codec="zstd")
        met = part if met is None else met.unionByName(part)
        release_shuffles(docs.sparkSession)
    late = met.filter("kind = 'unseen'").groupBy("bucket").cogroup(model.backoff.groupBy("bucket"))
    late = materialize(late.applyInArrow(_score_unseen, PACKED), "katz-late", codec="zstd")
    release_shuffles(docs.sparkSession)
    begin = math.log10(model.n_docs + E) if model.n_docs else 0.0
    return met.filter("kind in ('docs', 'sums')").unionByName(late).groupBy("block").applyInArrow(
        lambda t: _documents(t, begin),
        "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double",
    )


def score(docs: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, text, train boolean) to (what `apply` gives, number of training tokens). The model is
    learned from the rows where `train` is true, and every row is scored with its stored tables."""
    docs = docs.select("doc_id", "text", F.coalesce("train", F.lit(False)).alias("train"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    model = learn(docs.filter("train"), size)
    return apply(docs, model), model.total


FACTS = "buckets int, n_docs bigint, total bigint, distinct bigint, times array<bigint>, factors array<double>, hot array<bigint>, hot_n array<bigint>"


def save(model: Model, folder: str) -> None:
    """Write the model to a folder that all machines share."""
    facts = (model.buckets, model.n_docs, model.total, model.distinct, model.times, model.factors)
    row = (*facts, model.hot.view(np.int64).tolist(), model.hot_n.tolist())
    model.counts.write.parquet(f"{folder}/counts")
    model.backoff.write.parquet(f"{folder}/backoff")
    model.counts.sparkSession.createDataFrame([row], FACTS).coalesce(1).write.parquet(f"{folder}/facts")


def open_model(spark: SparkSession, folder: str) -> Model:
    """A model that was saved."""
    facts = spark.read.parquet(f"{folder}/facts").first().asDict()
    facts["hot"], facts["hot_n"] = np.array(facts["hot"], np.int64).view(np.uint64), np.array(facts["hot_n"], np.int64)
    return Model(**facts, counts=spark.read.parquet(f"{folder}/counts"), backoff=spark.read.parquet(f"{folder}/backoff"))
