"""Multilingual mixture inference for language identification.

Each language is a distribution over byte trigrams of letters. A document is a mixture: every
word comes from one language, drawn by the document's proportions. Expectation-maximisation
estimates the proportions from the words' likelihoods under each language. Languages are added
one by one, best first, as long as the likelihood gains more than the penalty of one parameter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import column, first_rows, of_sample, with_row_hash

# Trigrams are hashed to this many cells.
CELLS = 1 << 16
ROUNDS = 12
# Languages are learned from at most so many labelled rows, the smallest by hash of the id, and so
# many characters of them.
SAMPLE_DOCS = 8000
SAMPLE_CHARS = 64_000_000
# Longer texts are read in pieces, cut at blanks; without one, a run of twice as many characters is cut.
PIECE = 1 << 18
# Words whose likelihoods are mixed at a time.
WORDS = 1 << 16
UNKNOWN = "und"
_BLANK = re.compile(r"[\x00-\x40\x5B-\x60\x7B-\x7F]")
_LETTER = regex.compile(r"\p{L}")
# ASCII bytes that are no letters become blanks; capitals become small.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass
class Model:
    """Languages and the log-probability of each cell under each: (cells, languages)."""

    languages: list[str]
    logs: np.ndarray


def pieces(text: str) -> Iterator[str]:
    """A text in pieces of whole words."""
    at = 0
    while len(text) - at > PIECE:
        m = _BLANK.search(text, at + PIECE, at + 2 * PIECE)
        end = m.start() if m else min(at + 2 * PIECE, len(text))
        yield text[at:end]
        at = end
    yield text[at:]


def cells(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the trigrams of a text's words, blanks included, and where each word begins."""
    data = (" " + (text or "") + " ").encode("utf-8", "surrogatepass").translate(_TABLE)
    data = b" " + b" ".join(data.split()) + b" "
    codes = np.frombuffer(data, np.uint8).astype(np.int32)
    if len(codes) < 3:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    found = (codes[:-2] * 5501 + codes[1:-1] * 271 + codes[2:] * 31 * 67 + (codes[:-2] * codes[2:])) % CELLS
    # A trigram belongs to the word of its middle byte; those around a blank would belong to none.
    middle = codes[1:-1]
    inside = middle != 32
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    return found[inside], np.flatnonzero(begins[inside])


def _counts(batches: Iterator[pa.RecordBatch], languages: list[str]) -> Iterator[pa.RecordBatch]:
    """Trigram counts per language over the rows of a task: one row per language seen."""
    totals = np.zeros((len(languages), CELLS), np.int64)
    number = {name: i for i, name in enumerate(languages)}
    for batch in batches:
        for text, lang in zip(column(batch, "text"), column(batch, "lang")):
            for piece in pieces(text or ""):
                totals[number[lang]] += np.bincount(cells(piece)[0], minlength=CELLS)
    lang, cell = np.nonzero(totals)
    yield pa.RecordBatch.from_arrays(
        [pa.array(lang.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(totals[lang, cell])], ["lang", "cell", "n"]
    )


def learn(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """(doc_id, text, lang) to a model. Rows without text or language teach nothing.

    The sample is bounded in rows and characters and chosen by hash of the id, so it is the same in
    every run; a repeated row teaches once.
    """
    usable = labelled.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    hashed = with_row_hash(usable)
    keys = hashed.select("doc_id", "_row", F.length("text").alias("_chars"))
    sample = of_sample(hashed, first_rows(keys, sample_docs, SAMPLE_CHARS))
    languages = sorted(r.lang for r in sample.select("lang").distinct().collect())
    totals = np.zeros((CELLS, max(1, len(languages))), np.int64)
    rows = sample.mapInArrow(lambda b: _counts(b, languages), "lang int, cell int, n bigint")
    for r in rows.groupBy("lang", "cell").agg(F.sum("n").alias("n")).collect() if languages else ():
        totals[r.cell, r.lang] = r.n
    smooth = totals + 0.1
    return Model(languages, np.log(smooth / smooth.sum(axis=0)).astype(np.float64))


def mixture(words: np.ndarray, weights: np.ndarray, rounds: int = ROUNDS, spend: bool = False) -> tuple[np.ndarray, float]:
    """(proportions, log-likelihood) of a mixture over the columns of `words`, log-likelihoods of
    each word; by expectation-maximisation. With `spend`, `words` are written over."""
    top = words.max(axis=1, keepdims=True)
    likely = np.subtract(words, top, out=words if spend else None)
    np.exp(likely, out=likely)
    share = np.full(words.shape[1], 1 / words.shape[1])
    total = weights.sum()
    parts = [slice(at, at + WORDS) for at in range(0, len(words), WORDS)]
    for _ in range(rounds):
        raised = np.zeros(words.shape[1])
        for part in parts:
            joint = likely[part] * share
            raised += (weights[part] / joint.sum(axis=1)) @ joint
        share = np.maximum(raised / total, 1e-9)
        share /= share.sum()
    return share, float(sum(weights[part] @ (np.log(likely[part] @ share) + top[part, 0]) for part in parts))


def likelihoods(text: str, model: Model) -> np.ndarray:
    """(words, languages): each word's log-likelihood, a piece of the text after the other."""
    # Two characters a word at least, but where a run is cut; room that is not used is not taken.
    room = len(text) // 2 + 2 + len(text) // PIECE
    found, n = np.empty((room, len(model.languages))), 0
    for piece in pieces(text):
        cell, begins = cells(piece)
        if len(begins):
            found[n : n + len(begins)] = np.add.reduceat(model.logs[cell], begins, axis=0)
            n += len(begins)
    return found[:n]


def identify(text: str | None, model: Model) -> dict[str, float]:
    """Proportions of the languages selected for a text, largest first; empty if it has no letter."""
    if not model.languages or not text or not _LETTER.search(text):
        return {}
    words = likelihoods(text, model)
    if not len(words):
        return {}
    alone = np.ones(len(words)) @ words
    weights = np.broadcast_to(1.0, len(words))
    chosen = [int(alone.argmax())]
    best, share = float(alone[chosen[0]]), np.ones(1)
    penalty = 0.5 * np.log(len(words)) + 3.0
    if len(words) > 1:
        # How far the likelihood could rise if each word chose freely: mostly not far enough.
        free = float(words.max(axis=1).sum())
        while len(chosen) < len(model.languages) and free - best > penalty:
            trials = []
            for extra in range(len(model.languages)):
                # A language that explains no word better than those chosen adds nothing.
                gain = words[:, extra] - words[:, chosen].max(axis=1)
                if extra in chosen or float(gain[gain > 0].sum()) <= penalty:
                    continue
                trial = [*chosen, extra]
                trials.append((*mixture(words[:, trial], weights, spend=True)[::-1], trial))
            if not trials:
                break
            likelihood, shares, trial = max(trials, key=lambda t: t[0])
            if likelihood - best <= penalty:
                break
            best, share, chosen = likelihood, shares, trial
    order = np.argsort(-share, kind="stable")
    return {model.languages[chosen[i]]: float(share[i]) for i in order}


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, ...) to (doc_id, lang_pred, score, languages), one row per row of `docs`.

    `lang_pred` is the language of the largest proportion and `score` that proportion; `und` and 0
    for a null text, one without a letter, or when nothing was learned. `languages` maps the
    selected languages to their proportions. Only text is read, whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [identify(t, model) for t in column(batch, "text")]
            first = [next(iter(f.items()), (UNKNOWN, 0.0)) for f in found]
            ids = batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([f[0] for f in first], pa.string()),
                    pa.array([min(1.0, f[1]) for f in first], pa.float64()),
                    pa.array([list(f.items()) for f in found], pa.map_(pa.string(), pa.float64())),
                ],
                ["doc_id", "lang_pred", "score", "languages"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, lang_pred string, score double, languages map<string,double>"
    )


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with a language, in however many others they also are; what `predict` calls
    `und` is rejected. All columns and repeated rows are kept. The decision is made next to the
    row, so nothing is shuffled."""
    names = docs.columns
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [bool(identify(t, model)) for t in batch.column(names.index("text")).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)


def training_fold(docs: DataFrame, fold: Column) -> DataFrame:
    return docs.filter(F.coalesce(fold != 0, F.lit(False))).select("doc_id", "text", "lang")
