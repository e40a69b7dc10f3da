"""Fingerprints of documents that tell what differs: invertible Bloom lookup tables of paragraph digests.

A text is cut into paragraphs at line breaks, and these into pieces that end at words chosen by
their own hash, so that an edit changes the pieces around it and no others. Each piece has a
64-bit digest; a piece that occurs again is numbered, so that all digests of a text differ. The
digests go into a table of three rows of cells, one cell a row, each cell holding how many
digests it got, their sum and the sum of their check values. That table is the fingerprint.

Tables of equal size are subtracted cell by cell: what both texts have cancels out. A cell with a
single digest left gives it away; taken out of its two other cells it lays open further ones,
until the table is empty and both sides' own pieces are known. If cells are left, the difference
was too large for the table, and a table of twice the size is tried. All texts of a batch are
worked on together, as one long table.

The likeness of two texts is the share of pieces in common, 2 * common / (pieces + pieces), and 1
for two empty texts.

Defined cases: a null text is an empty one. The order of documents is that of ids, nulls last;
rows of equal id follow by hash of the text, and equal rows are interchangeable. An only document
is its own next one. Empty tables give empty results. Other columns are not read, and any names
they have are fine. A text is worked on in one task, a million characters at a time.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.operators.materialize import materialize

ROWS = 3
# Cells a row of the fingerprint; retries double it.
CELLS = 4
# One in so many words ends a piece.
PIECE_WORDS = 4
# Words longer than this are cut.
WORD_CHARS = 32
SLICE_CHARS = 1 << 20
# Half of a surrogate pair, which no text of Spark's can hold.
MARK = "\ud800"
# Texts that are worked on together, in characters.
BATCH_CHARS = 1 << 20
MEMO_WORDS = 200_000

RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double, cells int"
)


def mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash of 64-bit numbers."""
    x = x + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Marked(dict):
    """Words with a MARK where a piece begins or ends, found out once for each."""

    def __missing__(self, word: str) -> str:
        begins, ends = "\n" in word, zlib.crc32(word.strip().encode()) % PIECE_WORDS == 0
        self[word] = f"{MARK if begins else ''}{word}{MARK if ends else ''}"
        return self[word]


class Cutter:
    """Texts to the digests of their pieces. The words seen are kept."""

    def __init__(self):
        self.words = re.compile(rf"\s*\S{{1,{WORD_CHARS}}}|\s+").findall
        self.marked = _Marked()

    def pieces(self, text: str) -> list[str]:
        held, out = "", []
        for at in range(0, len(text), SLICE_CHARS):
            if len(self.marked) > MEMO_WORDS:
                self.marked.clear()
            words = map(self.marked.__getitem__, self.words(text[at : at + SLICE_CHARS]))
            *whole, held = f"{held}{''.join(words)}".split(MARK)
            out += whole
        return [p for p in [*out, held] if p]

    def digests(self, text: str) -> np.ndarray:
        """Distinct digests, one a piece: equal pieces of a text are told apart by their number."""
        digest = xxhash.xxh64_intdigest
        raw = np.array([digest(p.encode()) for p in self.pieces(text)], np.uint64)
        raw.sort()
        new = np.ones(len(raw), bool)
        new[1:] = raw[1:] != raw[:-1]
        firsts = np.flatnonzero(new)
        number = np.arange(len(raw)) - np.repeat(firsts, np.diff(np.append(firsts, len(raw))))
        return mix(raw + number.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), 0)


@dataclass
class Tables:
    """Tables of several texts: arrays by (text, row, cell), flat."""

    size: int
    counts: np.ndarray
    sums: np.ndarray
    checks: np.ndarray

    def __sub__(self, other: Tables) -> Tables:
        return Tables(self.size, self.counts - other.counts, self.sums - other.sums, self.checks - other.checks)

    def pick(self, chosen: np.ndarray) -> Tables:
        return Tables(self.size, *(a.reshape(-1, ROWS * self.size)[chosen].ravel() for a in (self.counts, self.sums, self.checks)))

    def to_bytes(self) -> list[bytes]:
        """Per text its cells: counts, then sums, then check values."""
        parts = [a.reshape(-1, ROWS * self.size).astype(k) for a, k in ((self.counts, "<i4"), (self.sums, "<u8"), (self.checks, "<u4"))]
        return [b"".join(p[i].tobytes() for p in parts) for i in range(len(parts[0]))]


def from_bytes(fingerprints: list[bytes]) -> Tables:
    """The tables of stored fingerprints of equal size."""
    cells = len(fingerprints[0]) // 16
    raw = np.frombuffer(b"".join(fingerprints), np.uint8).reshape(-1, 16 * cells)
    cut = [raw[:, : 4 * cells], raw[:, 4 * cells : 12 * cells], raw[:, 12 * cells :]]
    kinds = (np.int32, np.uint64, np.uint32)
    return Tables(cells // ROWS, *(np.ascontiguousarray(c).view(k).ravel() for c, k in zip(cut, kinds)))


def _places(texts: np.ndarray, keys: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The cell of each key in each row; other places for every size."""
    for row in range(ROWS):
        yield (texts * ROWS + row) * size + (mix(keys, size * ROWS + row) % np.uint64(size)).astype(np.int64)


def _check(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, -2) >> np.uint64(32)).astype(np.uint32)


def tables(digests: list[np.ndarray], size: int) -> Tables:
    n = len(digests) * ROWS * size
    out = Tables(size, np.zeros(n, np.int32), np.zeros(n, np.uint64), np.zeros(n, np.uint32))
    keys = np.concatenate([np.empty(0, np.uint64), *digests])
    texts = np.repeat(np.arange(len(digests)), [len(d) for d in digests])
    checks = _check(keys)
    for at in _places(texts, keys, size):
        out.counts += np.bincount(at, minlength=n).astype(np.int32)
        np.add.at(out.sums, at, keys)
        np.add.at(out.checks, at, checks)
    return out


def peel(table: Tables) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """(whether a text's table came out empty, [(text, digest, side)]) of tables that were subtracted.

    `side` is 1 for the first text's own digests and -1 for the other's. The tables are used up.
    """
    counts, sums, checks, width = table.counts, table.sums, table.checks, ROWS * table.size
    found = []
    # Every round takes out a digest of some cell; false ones, which could go on for ever, end as a failure.
    for _ in range(width + 1):
        single = np.flatnonzero((counts == 1) | (counts == -1))
        sign = counts[single]
        keys = np.where(sign > 0, sums[single], np.uint64(0) - sums[single])
        held = np.where(sign > 0, checks[single], np.uint32(0) - checks[single])
        pure = _check(keys) == held
        texts, keys, sign = single[pure] // width, keys[pure], sign[pure]
        if not len(keys):
            break
        order = np.lexsort((keys, texts))
        texts, keys, sign = texts[order], keys[order], sign[order]
        new = np.ones(len(keys), bool)
        new[1:] = (texts[1:] != texts[:-1]) | (keys[1:] != keys[:-1])
        texts, keys, sign = texts[new], keys[new], sign[new]
        found.append((texts, keys, sign))
        signed = np.where(sign > 0, keys, np.uint64(0) - keys)
        signed_checks = np.where(sign > 0, _check(keys), np.uint32(0) - _check(keys))
        for at in _places(texts, keys, table.size):
            np.subtract.at(counts, at, sign)
            np.subtract.at(sums, at, signed)
            np.subtract.at(checks, at, signed_checks)
    left = (counts != 0) | (sums != 0) | (checks != 0)
    return ~left.reshape(-1, width).any(axis=1), found


@dataclass
class Differences:
    """Per pair of texts: the size of the table that sufficed, and either side's own digests."""

    cells: np.ndarray
    own: list[list[np.ndarray]]

    def likeness(self, left: list[np.ndarray], right: list[np.ndarray]) -> list[float]:
        out = []
        for i, (a, b) in enumerate(zip(left, right)):
            both = len(a) + len(b)
            apart = sum(map(len, self.own[0][i])) + sum(map(len, self.own[1][i]))
            out.append((both - apart) / both if both else 1.0)
        return out


def differences(left: list[np.ndarray], right: list[np.ndarray], size: int = CELLS, first: Tables | None = None) -> Differences:
    """What is in one text of a pair alone, from their tables, which double until they suffice.

    `first` are the tables of size `size`, subtracted, where they are there already.
    """
    n = len(left)
    cells, own = np.zeros(n, np.int64), [[[] for _ in range(n)] for _ in range(2)]
    todo = np.arange(n)
    while len(todo):
        if first is None:
            first = tables([left[i] for i in todo], size) - tables([right[i] for i in todo], size)
        done, found = peel(first)
        cells[todo[done]] = size
        for texts, keys, sign in found:
            kept = done[texts]
            texts, keys, sign = texts[kept], keys[kept], sign[kept]
            for side in (1, -1):
                mine, whose = keys[sign == side], texts[sign == side]
                cuts = np.flatnonzero(np.diff(whose, prepend=-1))
                for a, b in zip(cuts, np.append(cuts[1:], len(whose))):
                    own[side < 0][todo[whose[a]]].append(mine[a:b])
        todo, first, size = todo[~done], None, 2 * size
    return Differences(cells, own)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the following text's beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_versions(ids: list, texts: list[str], followings: list[str], cutter: Cutter) -> pa.RecordBatch:
    """Rows of RESULT: each text beside its edited form and the following text."""
    forms = [edited(a, b) for a, b in zip(texts, followings)]
    own, new = [cutter.digests(t) for t in texts], [cutter.digests(t) for t in forms]
    # A following text is mostly the next one of the list.
    after = [own[i + 1] if i + 1 < len(texts) and texts[i + 1] is t else cutter.digests(t) for i, t in enumerate(followings)]
    own_tables, new_tables = tables(own, CELLS), tables(new, CELLS)
    to_edited = differences(own, new, first=own_tables - new_tables)
    to_next = differences(own, after)
    columns = [
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in forms], pa.string()),
        pa.array(own_tables.to_bytes(), pa.binary()),
        pa.array(new_tables.to_bytes(), pa.binary()),
        pa.array(to_edited.likeness(own, new), pa.float64()),
        pa.array(to_next.likeness(own, after), pa.float64()),
        pa.array(to_edited.cells, pa.int32()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "cells"])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str]]:
    for batch in batches:
        ids, texts = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text"))
        for doc_id, text in zip(ids.cast(pa.int64()), texts):
            yield doc_id.as_py(), text.as_py() or ""


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of RESULT for all rows of a task but its last, then one row with its first and last text."""
    ends = (pa.int32(), pa.string(), pa.string())
    names = ("part", "first_text", "last_text")

    def with_ends(batch: pa.RecordBatch) -> pa.RecordBatch:
        nothing = [pa.nulls(batch.num_rows, k) for k in ends]
        return pa.RecordBatch.from_arrays([*batch.columns, *nothing], [*batch.schema.names, *names])

    cutter, ids, texts, size, first = Cutter(), [], [], 0, None
    for doc_id, text in _walk(batches):
        first = text if first is None else first
        ids.append(doc_id)
        texts.append(text)
        size += len(text)
        if size >= BATCH_CHARS and len(texts) > 1:
            yield with_ends(compare_versions(ids[:-1], texts[:-1], texts[1:], cutter))
            ids, texts, size = ids[-1:], texts[-1:], len(text)
    if not texts:
        return
    if len(texts) > 1:
        yield with_ends(compare_versions(ids[:-1], texts[:-1], texts[1:], cutter))
    empty = compare_versions([], [], [], cutter)
    row = [pa.nulls(1, f.type) for f in empty.schema]
    row[0] = pa.array(ids[-1:], pa.int64())
    row += [pa.array([v], k) for v, k in zip((TaskContext.get().partitionId(), first, texts[-1]), ends)]
    yield pa.RecordBatch.from_arrays(row, [*empty.schema.names, *names])


def versions(docs: DataFrame) -> DataFrame:
    """Rows of RESULT: every text's fingerprint beside those of its edited form and of the next document.

    Documents are dealt out by ranges of ids and walked through in order, so that a text meets the
    one after it in its own task. A task's last text meets the first of the next task that has any:
    two texts a task, joined by the tasks' numbers.
    """
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    ranged = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    walked = materialize(ranged.mapInArrow(_in_order, f"{RESULT}, part int, first_text string, last_text string"), "versions")
    within = walked.filter("part is null").drop("part", "first_text", "last_text")
    # One row a task: its number, and the number of the task that follows.
    parts = walked.filter("part is not null").select("part")
    least = parts.agg(F.min("part")).scalar()
    following = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), least).alias("next_part"))
    ends = walked.filter("part is not null").select("part", "doc_id", "last_text").join(following, "part")
    firsts = walked.filter("part is not null").select(F.col("part").alias("next_part"), F.col("first_text"))

    def compare(batches):
        cutter = Cutter()
        for batch in batches:
            ids, texts, others = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "last_text", "first_text"))
            for i in range(len(ids)):
                yield compare_versions(ids[i : i + 1], texts[i : i + 1], others[i : i + 1], cutter)

    between = ends.join(firsts, "next_part").select("doc_id", "last_text", "first_text").mapInArrow(compare, RESULT)
    return within.unionByName(between)


def fingerprints(docs: DataFrame, size: int = CELLS) -> DataFrame:
    """(doc_id, n_pieces, fingerprint) of every text, in a table of `size` cells a row."""

    def sketch(batches):
        cutter = Cutter()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = list(_walk([batch.slice(at, 256)]))
                found = [cutter.digests(t) for _, t in rows]
                columns = [[i for i, _ in rows], [len(d) for d in found], tables(found, size).to_bytes()]
                kinds = (pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "n_pieces", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(sketch, "doc_id bigint, n_pieces bigint, fingerprint binary")


def changed_pieces(pairs: DataFrame) -> DataFrame:
    """(pair_id, only_l, only_r, likeness, cells) of pairs (pair_id, text_l, text_r).

    The digests of the pieces that one text has and the other has not, 16 hexadecimal digits each,
    in ascending order, and how large a table it took to recover them.
    """

    def shown(parts: list[np.ndarray]) -> list[str]:
        return [f"{x:016x}" for x in sorted(np.concatenate([np.empty(0, np.uint64), *parts]).tolist())]

    def compare(batches):
        cutter = Cutter()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                ids, *texts = (some.column(some.schema.get_field_index(c)) for c in ("pair_id", "text_l", "text_r"))
                left, right = ([cutter.digests(t or "") for t in c.to_pylist()] for c in texts)
                found = differences(left, right)
                strings = pa.list_(pa.string())
                columns = [ids, *(pa.array([shown(p) for p in side], strings) for side in found.own)]
                columns += [pa.array(found.likeness(left, right), pa.float64()), pa.array(found.cells, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["pair_id", "only_l", "only_r", "likeness", "cells"])

    kind = dict(pairs.dtypes)["pair_id"]
    schema = f"pair_id {kind}, only_l array<string>, only_r array<string>, likeness double, cells int"
    return pairs.select("pair_id", "text_l", "text_r").mapInArrow(compare, schema)
