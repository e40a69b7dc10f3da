"""Spelling variants: words one edit apart, found in a sorted permuterm index.

A word ended by a terminator has as many rotations as it has letters and one. With the rotations
of all words sorted, words that differ in one letter stand together: rotate both so that this
letter comes last, and what is before it is the same. A word that lacks the letter has what is
before it as a whole rotation of its own. So each stretch of the index that begins with the same
rotation, up to the last letter, holds a word without the letter, if there is one, and the words
with some letter there: all of them are one edit apart from each other, and any two words one edit
apart meet in exactly one stretch, if of equal letters in a row only the last is taken as the one
that the shorter word lacks.

A stretch has at most one row for every letter of the alphabet and one more, so no key is hot,
and neighbours are counted and the best one found by windows over it, without forming pairs.

Defined cases: null texts have no words; a null id counts as an empty one; empty tables give empty
results. Equal words are one word, whatever rows they come from; ties between neighbours go to the
first in code point order. Other columns are not read, and any names they have are fine.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import column
from linkloom.operators.materialize import materialize

# Words hold letters alone, so that this is none of them.
TERMINATOR = "$"
LETTERS = "[A-Za-zÀ-ÿ]+"
# One in so many words of a text loses a letter, by hash.
EDIT_EVERY = 31
# How much more frequent a word must be to be the form of its neighbour.
FACTOR = 10
# Distinct words that a task holds before it passes them on.
HELD_WORDS = 200_000
SLICE_CHARS = 1 << 20


def _text_words(text: str) -> Counter:
    """Runs of letters with their numbers, A-Z in small letters; a long text is read in slices."""
    counts: Counter = Counter()
    find = re.compile(LETTERS).findall
    at = 0
    while at < len(text):
        end = min(at + SLICE_CHARS, len(text))
        # Move the end of a slice behind the word it is in.
        inside = re.compile(LETTERS).match(text, end) if end < len(text) else None
        end = inside.end() if inside else end
        counts.update("\n".join(find(text, at, end)).encode().lower().split(b"\n"))
        at = end
    counts.pop(b"", None)
    return counts


def _count(batches: Iterator[pa.RecordBatch], every: int) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
        held.clear()
        return out

    for batch in batches:
        for doc_id, text in zip(column(batch, "doc_id"), column(batch, "text")):
            # A checksum goes on where that of the beginning has ended.
            begun = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for word, n in _text_words(text or "").items():
                h, word = zlib.crc32(word, begun), word.decode()
                if every and h % every == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
                if word:
                    held[word] += n
            if len(held) >= HELD_WORDS:
                yield flush()
    yield flush()


def edited_words(docs: DataFrame, every: int = EDIT_EVERY) -> DataFrame:
    """(word, n): the words of all texts and how often they occur.

    Where `every` divides the hash of a text's id and a word, that word loses a letter in that text,
    so that there are misspellings to find; 0 leaves all words as they are.
    """
    rows = docs.select("doc_id", "text").mapInArrow(lambda batches: _count(batches, every), "word string, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def rotations(words: DataFrame) -> DataFrame:
    """(key, letter, lacks, word, n): the permuterm index, cut before the letter that may differ.

    A row with a letter is the rotation that ends in it. Its key is what is before, that is, a
    whole rotation of the word without the letter; `lacks` is false where an equal letter follows
    it in the word, whose loss gives the same word. A row without a letter is a whole rotation.
    """
    length = F.char_length("word")
    head = lambda i: F.substring(F.col("word"), F.lit(1), i)
    tail = lambda i: F.substring(F.col("word"), i + 1, length)
    # The rotation whose last letters are the first i ones of the word.
    rows = words.select("word", "n", F.explode(F.sequence(F.lit(0), length)).alias("i"))
    i = F.col("i")
    whole = F.struct(
        F.concat(tail(i), F.lit(TERMINATOR), head(i)).alias("key"), F.lit("").alias("letter"), F.lit(True).alias("lacks")
    )
    letter = F.substring(F.col("word"), i, F.lit(1))
    cut = F.struct(
        F.concat(tail(i), F.lit(TERMINATOR), head(i - 1)).alias("key"),
        letter.alias("letter"),
        (F.substring(F.col("word"), i + 1, F.lit(1)) != letter).alias("lacks"),
    )
    each = rows.select("word", "n", F.explode(F.when(i == 0, F.array(whole)).otherwise(F.array(whole, cut))).alias("r"))
    return each.select("r.key", "r.letter", "r.lacks", "word", "n")


def _rank() -> Column:
    """Small for frequent words, then by code point."""
    return F.struct((-F.col("n")).alias("less"), F.col("word").alias("word"))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, near, near_n): how many words are one edit apart, and the most frequent of them.

    Words without any neighbour are left out.
    """
    stretch = Window.partitionBy("key")
    index = rotations(words).repartitionByRange("key").withColumn("_rows", F.count("*").over(stretch)).filter("_rows > 1")
    has_letter, lacks = F.col("letter") != "", F.col("lacks")
    ordered = stretch.orderBy(F.desc(has_letter), F.desc("n"), "word")
    members = (
        index.withColumn("_at", F.row_number().over(ordered))
        .withColumn("_next", F.lead(F.when(has_letter, _rank())).over(ordered))
        .withColumn("_with", F.count_if(has_letter).over(stretch))
        .withColumn("_losing", F.count_if(has_letter & lacks).over(stretch))
        .withColumn("_first", F.min(F.when(has_letter, _rank())).over(stretch))
        .withColumn("_first_losing", F.min(F.when(has_letter & lacks, _rank())).over(stretch))
        .withColumn("_without", F.min(F.when(~has_letter, _rank())).over(stretch))
    )
    other = F.when(F.col("_at") == 1, F.col("_next")).otherwise(F.col("_first"))
    shorter = F.when(lacks, F.col("_without"))
    found = members.select(
        "word",
        F.when(has_letter, F.col("_with") - 1 + shorter.isNotNull().cast("int")).otherwise(F.col("_losing")).alias("n_near"),
        F.when(has_letter, F.least(other, shorter)).otherwise(F.col("_first_losing")).alias("near"),
    ).filter("n_near > 0")
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), F.min("near").alias("near"))
        .select("word", "n_near", F.col("near.word").alias("near"), (-F.col("near.less")).alias("near_n"))
    )


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of words (word, n), each once.

    The form of a word is its most frequent neighbour, if `factor` times as frequent at least; the
    root is what forms lead to. Every step along forms multiplies the number by `factor`, so
    the way to the root is short, and each round doubles what has been gone of it.
    """
    if factor < 2:
        raise ValueError("forms must be more frequent than their variants")
    words = materialize(words, "words")
    near = near_words(words)
    good = F.col("near_n") >= factor * F.col("n")
    known = materialize(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(good, F.col("near")).alias("form"),
            F.when(good, F.col("near_n")).alias("form_n"),
        ),
        "near-words",
    )
    # Only words with a form move; there are at most as many steps as numbers can grow.
    moves = known.filter("form is not null").select("word", F.col("form").alias("root"))
    steps = math.ceil(math.log(2**63, factor))
    for _ in range(math.ceil(math.log2(steps))):
        onward = moves.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        moved = materialize(moves.join(onward, "root", "left"), "spelling-steps")
        moves = moved.select("word", F.coalesce("_further", "root").alias("root"))
        if moved.filter("_further is not null").isEmpty():
            break
    return known.join(moves, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
