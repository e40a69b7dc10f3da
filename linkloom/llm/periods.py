"""Stretches of repeated words, found by catchers over dyadic blocks while words are appended.

A square is a stretch followed by itself; its period is the length of the stretch. Squares of the
same period that overlap by a period or more are one run: a stretch in which words `period` apart
are identical, and which cannot be made longer on either side.

Blocks of 2**t words, one after the other, are the catchers of level t. A block is complete once
its last word is appended; from then on it waits for its own words at a distance of 2 to 4 blocks
(level 0: 1 to 4 words). Every appended word ends one suffix of 2**t words a level, and that
suffix is in reach of two catchers (three at level 0), so a word costs a constant number of
comparisons a level. The first half of a square with a period from 2 blocks on holds a whole
block, so that none is missed. Suffixes are compared by polynomial hashes; runs are compared
word by word before they are reported, and found again with another base should a hash have lied.

Defined cases: a null text has no words; a null id leaves its text as it is (`seeded_repeats`);
empty tables give empty results; other columns are not read, and any names they have are fine.
Rows are independent, so repeated rows give repeated results. Texts are never cut; the words of
one text are held by one task, about 100 bytes for each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import column

# The modulus of the hashes; products of two residues fit 64 bits.
PRIME = (1 << 31) - 1
# Words that are searched together; a longer text is searched on its own.
BATCH_WORDS = 1 << 18
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo PRIME, doubled in length step by step."""
    out = np.ones(max(n, 1), np.uint64)
    have = 1
    while have < n:
        step = np.uint64(pow(base, have, PRIME))
        more = min(have, n - have)
        out[have : have + more] = out[:more] * step % PRIME
        have += more
    return out


def _chains(keys: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive blocks under the same key, as (key, first block, last block)."""
    order = np.lexsort((blocks, keys))
    keys, blocks = keys[order], blocks[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (blocks[1:] != blocks[:-1] + 1)
    firsts = np.flatnonzero(new)
    lasts = np.append(firsts[1:], len(keys)) - 1
    return keys[firsts], blocks[firsts], blocks[lasts]


class SquareCatchers:
    """Words are appended in pieces of any size, down to one at a time; `runs` may be asked at any time.

    `longest` bounds the periods that are looked for (None: all that fit), `exponent` is how many
    periods a run must hold at least, 2 or more.
    """

    def __init__(self, exponent: int = 2, longest: int | None = None, seed: int = 1):
        if exponent < 2:
            raise ValueError("a run holds two periods at least")
        self.exponent, self.longest, self.seed = exponent, longest, seed
        self.words = np.empty(0, np.int64)
        self._restart()

    def _restart(self) -> None:
        self.base = int(np.random.default_rng(self.seed).integers(2, PRIME - 1))
        self.sums = np.zeros(1, np.uint64)
        self.n = 0
        self.powers = self.inverse = np.ones(1, np.uint64)
        # Per level: (period, first block, last block) of blocks that met their own words again.
        self.caught: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def append(self, words: np.ndarray) -> None:
        """Words are numbers of any kind below PRIME: equal words, equal numbers."""
        self.words = np.concatenate([self.words, np.asarray(words, np.int64)])
        self._advance()

    def _advance(self) -> None:
        old, self.n = self.n, len(self.words)
        if len(self.powers) <= self.n:
            room = max(2 * len(self.powers), self.n + 1)
            self.powers, self.inverse = _powers(self.base, room), _powers(pow(self.base, -1, PRIME), room)
        values = (self.words[old:].astype(np.uint64) + np.uint64(1)) * self.powers[old : self.n] % PRIME
        # The sums are kept below PRIME; they grow by less than 2**31 a word.
        for at in range(0, len(values), 1 << 30):
            piece = values[at : at + (1 << 30)]
            self.sums = np.concatenate([self.sums, (self.sums[-1] + np.cumsum(piece, dtype=np.uint64)) % PRIME])
        level = 0
        while (3 << level if level else 2) <= self.n and (self.longest is None or (2 << level if level else 1) <= self.longest):
            self._compare(level, old)
            level += 1

    def _hashes(self, starts: np.ndarray | slice, size: int) -> np.ndarray:
        """The hash of the `size` words from each start on; equal words, equal hashes."""
        if isinstance(starts, slice):
            ends = slice(starts.start + size, starts.stop + size)
            return (self.sums[ends] + (PRIME - self.sums[starts])) % PRIME * self.inverse[starts] % PRIME
        return (self.sums[starts + size] + (PRIME - self.sums[starts])) % PRIME * self.inverse[starts] % PRIME

    def _compare(self, level: int, old: int) -> None:
        """The suffixes that end in the new words, with the catchers of a level that they are in reach of."""
        size = 1 << level
        low = max(old - size + 1, 0)
        # Enough for both catchers of the first new suffix.
        first = max(low // size - 3, 0) * size
        hashes = self._hashes(slice(first, self.n - size + 1), size)
        blocks = hashes[::size]
        starts = np.arange(low, self.n - size + 1)
        own = hashes[low - first :]
        periods, at = [], []
        for back in (1, 2, 3) if level == 0 else (2, 3):
            block = starts // size - back
            met = block >= 0
            met[met] = blocks[block[met] - first // size] == own[met]
            periods.append(starts[met] - block[met] * size)
            at.append(block[met])
        periods, at = np.concatenate(periods), np.concatenate(at)
        if self.longest is not None:
            periods, at = periods[periods <= self.longest], at[periods <= self.longest]
        if level == len(self.caught):
            self.caught.append((np.empty(0, np.int64),) * 3)
        if len(at):
            known = self.caught[level]
            keys, firsts, lasts = _chains(periods, at)
            self.caught[level] = tuple(np.concatenate(pair) for pair in zip(known, (keys, firsts, lasts)))

    def _joined(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The chains of a level, those that went on in a later piece put together."""
        keys, firsts, lasts = self.caught[level]
        order = np.lexsort((firsts, keys))
        keys, firsts, lasts = keys[order], firsts[order], lasts[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (firsts[1:] != lasts[:-1] + 1)
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(keys))[: len(heads)] - 1
        return keys[heads], firsts[heads], lasts[tails]

    def _reach(self, edge: np.ndarray, periods: np.ndarray, size: int, forward: bool) -> np.ndarray:
        """Move the edges outwards while words a period apart agree: by less than a block."""
        edge = edge.copy()
        step = size // 2
        while step:
            starts = edge if forward else edge - step
            fits = (edge + step + periods <= self.n) if forward else (starts >= 0)
            same = np.zeros(len(edge), bool)
            same[fits] = self._hashes(starts[fits], step) == self._hashes(starts[fits] + periods[fits], step)
            edge[same] += step if forward else -step
            step //= 2
        return edge

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, period) of all maximal runs so far, by start and then period."""
        while True:
            starts, ends, periods = self._candidates()
            # Hashes agree for more than the words do only by bad luck; then another base is drawn.
            if all(np.array_equal(self.words[a : b - p], self.words[a + p : b]) for a, b, p in zip(starts, ends, periods)):
                return starts, ends - starts, periods
            self.seed += 1
            self._restart()
            self._advance()

    def _candidates(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = [(np.empty(0, np.int64),) * 3]
        for level in range(len(self.caught)):
            size = 1 << level
            periods, firsts, lasts = self._joined(level)
            # Words that agree over (exponent - 1) periods hold at least so many whole blocks.
            enough = lasts - firsts + 1 >= ((self.exponent - 1) * periods - size + 1) // size
            periods, firsts, lasts = periods[enough], firsts[enough], lasts[enough]
            left = self._reach(firsts * size, periods, size, False)
            right = self._reach((lasts + 1) * size, periods, size, True) + periods
            whole = right - left >= self.exponent * periods
            found.append((left[whole], right[whole], periods[whole]))
        starts, ends, periods = (np.concatenate(c) for c in zip(*found))
        # The same stretch at multiples of its period is the same run.
        order = np.lexsort((periods, ends, starts))
        starts, ends, periods = starts[order], ends[order], periods[order]
        new = np.ones(len(starts), bool)
        new[1:] = (starts[1:] != starts[:-1]) | (ends[1:] != ends[:-1])
        return starts[new], ends[new], periods[new]


@dataclass(frozen=True)
class Rule:
    """Which runs count: those of `exponent` periods and `length` words at least."""

    exponent: int = 4
    length: int = 6


def find_runs(texts: list[list[bytes]], rule: Rule) -> list[np.ndarray]:
    """Per text its runs as rows (start, length, period), by start and then period.

    The texts are appended to one another with a word of its own after each, which no run can
    hold, so that short texts share the cost of a search.
    """
    numbers: dict[bytes, int] = {}
    bounds = np.cumsum([0] + [len(words) + 1 for words in texts])
    ids = np.empty(int(bounds[-1]), np.int64)
    for at, words in zip(bounds, texts):
        ids[at : at + len(words)] = [numbers.setdefault(w, len(numbers)) for w in words]
    ids[bounds[1:] - 1] = len(numbers) + np.arange(len(texts))
    catchers = SquareCatchers(rule.exponent, max(max(map(len, texts), default=0) // rule.exponent, 1))
    catchers.append(ids)
    found = np.stack(catchers.runs(), axis=1)
    found = found[found[:, 1] >= rule.length]
    cuts = np.searchsorted(found[:, 0], bounds)
    out = [found[a:b] - np.array([at, 0, 0]) for a, b, at in zip(cuts, cuts[1:], bounds)]
    return [x[np.lexsort((x[:, 2], x[:, 0]))] for x in out]


def collapse(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that any run holds after its first period."""
    if not len(runs):
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edges)[:-1] == 0)]


def seeded_repeats(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with a repeated stretch for every tenth id: from word a on, the p words from there again and again."""
    h = zlib.crc32(str(doc_id).encode())
    n = len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def _batches(batches: Iterator[pa.RecordBatch], seeded: bool) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Documents with their words, as many as are searched together."""
    ids, texts, size = [], [], 0
    for batch in batches:
        doc_ids, held = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text"))
        for doc_id, text in zip(doc_ids.cast(pa.int64()), held):
            doc_id, words = doc_id.as_py(), (text.as_py() or "").encode().split()
            ids.append(doc_id)
            texts.append(seeded_repeats(words, doc_id) if seeded else words)
            size += len(words) + 1
            if size >= BATCH_WORDS:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def periodic_runs(docs: DataFrame, rule: Rule = Rule(), seeded: bool = False) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the runs of every text, and the text without repetition.

    Words are what blanks and tab to carriage return separate; `collapsed` joins the words that
    are left by one blank. With `seeded` every tenth text is given a repeated stretch first.
    """
    fields = ("start", "length", "period")
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([(f, pa.int64()) for f in fields])), pa.string())
    schema = pa.schema(list(zip(("doc_id", "n_words", "runs", "collapsed"), kinds)))

    def search(batches):
        for ids, texts in _batches(batches, seeded):
            found = find_runs(texts, rule)
            runs = [[dict(zip(fields, run)) for run in rows.tolist()] for rows in found]
            left = [b" ".join(collapse(words, rows)).decode() for words, rows in zip(texts, found)]
            columns = [ids, [len(words) for words in texts], runs, left]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(search, f"doc_id bigint, n_words bigint, runs array<{RUN}>, collapsed string")


def strongest() -> Column:
    """Of the column `runs`, the one with the greatest length / period; the first among equals, null if there is none."""
    better = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    return F.aggregate("runs", F.get("runs", 0), lambda a, b: F.when(better(a, b), b).otherwise(a))


def listed() -> Column:
    """The column `runs` as lines `start,length,period`."""
    return F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"], F.lit("\n")))), "")
