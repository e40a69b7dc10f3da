"""Benchmark decontamination with a positional inverted index.

The training texts are cut into shards of about `SHARD_WORDS` words. Each shard is one row of a
written table: for every term that a benchmark item has, the sorted positions where it stands.
Documents follow each other within a shard with a gap between them that no phrase can bridge, so
positions need no document number. A phrase is searched per shard: the position lists of its
terms, rarest in the whole corpus first, are shifted by the term's offset and intersected. Index
and search are narrow stages; texts and positions are never shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import column, plain_words
from linkloom.operators.materialize import materialize

SHARD_WORDS = 1_000_000
# Words of benchmark items that are searched in one pass; more items take more passes.
PASS_WORDS = 2_000_000
WINDOW = 10

INDEX_SCHEMA = (
    "shard bigint, doc_ids array<bigint>, doc_starts array<bigint>, n_words array<bigint>, "
    "terms array<int>, term_starts array<bigint>, positions binary"
)
HIT_SCHEMA = "shard bigint, doc int, doc_id bigint, n_words bigint, spans array<struct<start:bigint,end:bigint>>, item_ids array<string>"


@dataclass
class Phrases:
    """Distinct phrases of some benchmark items, as term numbers."""

    terms: dict[bytes, int] = field(default_factory=dict)
    phrases: dict[tuple[int, ...], list[str | None]] = field(default_factory=lambda: defaultdict(list))

    @classmethod
    def of(cls, items: Iterable[tuple[str | None, list[bytes]]], window: int) -> Phrases:
        """Every `window` consecutive words of an item; all of a shorter one. No words: none."""
        found = cls()
        for name, words in items:
            ids = [found.terms.setdefault(w, len(found.terms)) for w in words]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                owners = found.phrases[tuple(ids[at : at + window])]
                if not owners or owners[-1] != name:
                    owners.append(name)
        return found


def _shards(batches: Iterator[pa.RecordBatch], terms: dict[bytes, int], gap: int) -> Iterator[pa.RecordBatch]:
    """Documents to index rows. Words that no item has are counted but not stored."""
    part, seq = TaskContext.get().partitionId(), 0
    ids, starts, counts, lists, at = [], [], [], [], 0
    find, schema = terms.get, _arrow_index()

    def flush() -> pa.RecordBatch:
        numbers = np.concatenate(lists) if lists else np.empty((0, 2), np.int64)
        order = np.argsort(numbers[:, 0], kind="stable")
        found, first = np.unique(numbers[order, 0], return_index=True)
        row = {
            "shard": (part << 32) + seq,
            "doc_ids": ids,
            "doc_starts": starts,
            "n_words": counts,
            "terms": found.astype(np.int32),
            "term_starts": first.astype(np.int64),
            # A text has fewer than 2**30 words, so positions within a shard fit four bytes.
            "positions": numbers[order, 1].astype("<i4").tobytes(),
        }
        return pa.RecordBatch.from_pylist([row], schema)

    for batch in batches:
        for doc_id, text in zip(column(batch, "doc_id"), column(batch, "text")):
            words = plain_words(text)
            numbers = np.fromiter((find(w, -1) for w in words), np.int64, len(words))
            where = np.flatnonzero(numbers >= 0)
            ids.append(doc_id)
            starts.append(at)
            counts.append(len(words))
            if len(where):
                lists.append(np.column_stack((numbers[where], where + at)))
            at += len(words) + gap
            if at >= SHARD_WORDS:
                yield flush()
                ids, starts, counts, lists, at, seq = [], [], [], [], 0, seq + 1
    if ids:
        yield flush()


def _arrow_index() -> pa.Schema:
    longs = pa.list_(pa.int64())
    return pa.schema(
        [
            ("shard", pa.int64()),
            ("doc_ids", longs),
            ("doc_starts", longs),
            ("n_words", longs),
            ("terms", pa.list_(pa.int32())),
            ("term_starts", longs),
            ("positions", pa.binary()),
        ]
    )


def _arrow_hits() -> pa.Schema:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    return pa.schema(
        [
            ("shard", pa.int64()),
            ("doc", pa.int32()),
            ("doc_id", pa.int64()),
            ("n_words", pa.int64()),
            ("spans", pa.list_(span)),
            ("item_ids", pa.list_(pa.string())),
        ]
    )


def build_index(docs: DataFrame, phrases: Phrases, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """(doc_id, text) to the written index over the terms of `phrases`."""
    terms, gap = phrases.terms, window + 2 * slop + 1
    shards = docs.select("doc_id", "text").mapInArrow(lambda batches: _shards(batches, terms, gap), INDEX_SCHEMA)
    return materialize(shards, "postings")


def term_counts(index: DataFrame) -> DataFrame:
    """(term, n): occurrences of each stored term in the whole corpus, from the index alone."""
    ends = F.concat(
        F.slice("term_starts", 2, F.greatest(F.size("term_starts"), F.lit(1))),
        F.array((F.octet_length("positions") / 4).cast("bigint")),
    )
    return (
        index.filter(F.size("terms") > 0)
        .select(F.inline(F.arrays_zip("terms", "term_starts", ends.alias("ends"))))
        .groupBy(F.col("terms").alias("term"))
        .agg(F.sum(F.col("ends") - F.col("term_starts")).alias("n"))
    )


def occurrences(lists: dict[int, np.ndarray], phrase: tuple[int, ...], order: list[int], slop: int) -> np.ndarray:
    """Start positions of a phrase: shifted lists intersected, in the given order of offsets.

    With `slop`, a term may stand up to that many words away from its place after the anchor,
    the term of the first offset in `order`.
    """
    starts = None
    for offset in order:
        places = lists.get(phrase[offset])
        if places is None:
            return np.empty(0, np.int64)
        if starts is None:
            starts = places - offset
            continue
        at = np.searchsorted(places, starts + offset - slop)
        near = places[np.minimum(at, len(places) - 1)]
        starts = starts[(near >= starts + offset - slop) & (near <= starts + offset + slop)]
        if not len(starts):
            break
    return starts


def _merged(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Intervals [start, end) joined where they touch."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1])))
    last = np.append(first[1:], len(start)) - 1
    return list(zip(start[first].tolist(), end[last].tolist()))


def _search(
    batches: Iterator[pa.RecordBatch], plan: list[tuple[tuple[int, ...], list[int], list[str | None]]], slop: int
) -> Iterator[pa.RecordBatch]:
    schema = _arrow_hits()
    for batch in batches:
        for row in batch.to_pylist():
            positions = np.frombuffer(row["positions"], "<i4").astype(np.int64)
            bounds = [*row["term_starts"], len(positions)]
            lists = {t: positions[a:b] for t, a, b in zip(row["terms"], bounds, bounds[1:])}
            starts, ends, owners = [], [], []
            for number, (phrase, order, _) in enumerate(plan):
                if phrase[order[0]] not in lists:
                    continue
                found = occurrences(lists, phrase, order, slop)
                if len(found):
                    starts.append(found - slop)
                    ends.append(found + len(phrase) + slop)
                    owners.append(np.full(len(found), number))
            spans, items = defaultdict(list), defaultdict(set)
            if starts:
                begin, end, owner = map(np.concatenate, (starts, ends, owners))
                firsts = np.array(row["doc_starts"])
                doc = np.searchsorted(firsts, begin + slop, side="right") - 1
                for d in np.unique(doc).tolist():
                    mine = doc == d
                    low, high = firsts[d], firsts[d] + row["n_words"][d]
                    spans[d] = [
                        (a - low, b - low)
                        for a, b in _merged(np.maximum(begin[mine], low), np.minimum(end[mine], high))
                    ]
                    items[d] = {i for p in np.unique(owner[mine]).tolist() for i in plan[p][2] if i is not None}
            hits = [
                {
                    "shard": row["shard"],
                    "doc": d,
                    "doc_id": doc_id,
                    "n_words": n,
                    "spans": [{"start": a, "end": b} for a, b in spans.get(d, ())],
                    "item_ids": sorted(items.get(d, ())),
                }
                for d, (doc_id, n) in enumerate(zip(row["doc_ids"], row["n_words"]))
            ]
            for at in range(0, len(hits), 4096):
                yield pa.RecordBatch.from_pylist(hits[at : at + 4096], schema)


def search(index: DataFrame, phrases: Phrases, counts: dict[int, int], slop: int = 0) -> DataFrame:
    """Per document: merged spans of words in matches, and the ids of the matching items."""
    rare = lambda phrase: sorted(range(len(phrase)), key=lambda i: (counts.get(phrase[i], 0), i))
    plan = [(p, rare(p), owners) for p, owners in phrases.phrases.items()]
    plan = [x for x in plan if all(counts.get(t) for t in x[0])]
    return index.mapInArrow(lambda batches: _search(batches, plan, slop), HIT_SCHEMA)


def _covered(spans: Column) -> Column:
    """Words covered by spans, which may overlap between passes."""
    ordered = F.array_sort(spans)
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("to"))
    return F.aggregate(
        ordered,
        start,
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(s["end"] - F.greatest(s["start"], acc["to"]), F.lit(0).cast("bigint"))).alias("n"),
            F.greatest(acc["to"], s["end"]).alias("to"),
        ),
        lambda acc: acc["n"],
    )


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0, unnamed: bool = False) -> DataFrame:
    """(doc_id, n_words, n_hit, item_ids, spans): what each document holds of the benchmark.

    A phrase is `window` consecutive words of an item, or a shorter item as a whole. `n_hit`
    counts the document's words inside any occurrence of a phrase, `spans` [start, end) are
    their word numbers, `item_ids` the matching items as strings in order. One row per row of
    `docs`: repeated rows and null ids are kept, a null or empty text has no words. Items without
    words match nothing, and equal items all match; an empty benchmark leaves every document
    clean. Columns other than ids and texts are not looked at. With `unnamed`, items with a null id
    are searched like others: their words are hit, but they are not in `item_ids`.

    Benchmark items go to the tasks as a broadcast of at most `PASS_WORDS` words. A larger
    benchmark is searched in several passes over disjoint sets of items, and the spans of a
    document are united.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter(
        F.col("text").isNotNull() & (F.lit(unnamed) | F.col("item_id").isNotNull())
    )
    longest = items.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = longest // PASS_WORDS + 1
    found = []
    for number in range(passes):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == number)
        rows = sorted(map(tuple, part.collect()), key=lambda r: (r[0] is None, r[0] or "", r[1]))
        phrases = Phrases.of([(name, plain_words(text)) for name, text in rows], window)
        index = build_index(docs, phrases, window, slop)
        counts = {r.term: r.n for r in term_counts(index).collect()}
        found.append(search(index, phrases, counts, slop))
    if passes == 1:
        every = found[0].select("doc_id", "n_words", "spans", "item_ids")
    else:
        # Shards depend on the tasks of the scan alone, so a document has the same number in each pass.
        for hits in found[1:]:
            found[0] = found[0].unionByName(hits)
        every = (
            found[0]
            .groupBy("shard", "doc")
            .agg(
                F.first("doc_id").alias("doc_id"),
                F.first("n_words").alias("n_words"),
                F.flatten(F.collect_list("spans")).alias("spans"),
                F.flatten(F.collect_list("item_ids")).alias("item_ids"),
            )
            .drop("shard", "doc")
        )
    return every.select(
        "doc_id",
        "n_words",
        _covered(F.col("spans")).alias("n_hit"),
        F.array_sort(F.array_distinct("item_ids")).alias("item_ids"),
        "spans",
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of `docs` whose text holds no phrase of the benchmark, all columns kept.

    Rows go by the hash of their text beside the id, so that of several rows with one id only
    those with a leak go. Items with a null id count. What is looked up are the leaking rows alone.
    """
    keyed = docs.withColumn("__leak_key", F.xxhash64("text"))
    # The index keeps one number per document; here that is the text's hash.
    hashed = keyed.select(F.col("__leak_key").alias("doc_id"), "text")
    found = find_leaks(hashed, benchmark, window, unnamed=True).filter("n_hit > 0").select("doc_id").distinct()
    leaking = materialize(found.select(F.col("doc_id").alias("__leak")), "leaking")
    return keyed.join(leaking, F.col("__leak_key") == F.col("__leak"), "left_anti").select(*docs.columns)
