"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is logistic in its words, and a word's
weight is the sum of those of the character n-grams in it; the document's probability is the
noisy-or of its sentences: one minus the product of their complements. Only documents have labels,
and the gradient of the document's likelihood tells each sentence how much of it is to blame. What
was learned locates the sentences that make a document toxic.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import column, first_rows, of_sample, with_row_hash
from linkloom.operators.materialize import materialize

# The model is fitted on at most so many labelled rows, the smallest by hash of the id, and so many
# characters of them.
SAMPLE_DOCS = 8_000
SAMPLE_CHARS = 64_000_000
# It knows so many character n-grams: those whose presence tells most about the label.
FEATURES = 512
GRAMS = (4, 5, 6)
MIN_DOCS = 4
STEPS = 400
RIDGE = 0.3
MEMO_WORDS = 400_000
_SENTENCE = re.compile(r"[.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def sentences(text: str | None) -> Iterator[tuple[int, int]]:
    """[start, end) of each sentence: runs without `.`, `!`, `?` or line feed that are not blank."""
    text, at = text or "", 0
    for m in _SENTENCE.finditer(text):
        if text[at : m.start()].strip():
            yield at, m.start()
        at = m.end()
    if text[at:].strip():
        yield at, len(text)


def grams(word: str) -> set[str]:
    """The n-grams of a word with its ends marked, and the marked word itself."""
    marked = f"^{word}$"
    return {marked} | {marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)}


@dataclass
class Model:
    """`base` is the log-odds of a sentence without known n-grams, `weights` what each n-gram of
    each distinct word adds."""

    base: float
    weights: dict[str, float]


class WordWeights(dict):
    """Weight of a word, worked out when first asked for; emptied by its user when too large."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        found = self.weights.keys() & grams(word)
        self[word] = value = sum(self.weights[g] for g in sorted(found))
        return value


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per n-gram the number of documents with it, by label, over the rows of a task."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, label in zip(column(batch, "text"), column(batch, "label")):
            seen[label].update(set().union(*map(grams, set(_WORD.findall(text.lower())))))
    found = list(seen[0].keys() | seen[1].keys())
    yield pa.RecordBatch.from_arrays(
        [pa.array(found, pa.string()), *(pa.array([s[g] for g in found], pa.int64()) for s in seen)], ["gram", "clean", "toxic"]
    )


def _patterns(batches: Iterator[pa.RecordBatch], known: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """Each document as its distinct sentences (known n-grams of their words, with repeats) and
    how often each occurs."""
    memo: dict[str, list[int]] = {}
    for batch in batches:
        rows = []
        for text, label in zip(column(batch, "text"), column(batch, "label")):
            found = Counter()
            for a, b in sentences(text):
                ids: list[int] = []
                for w in set(_WORD.findall(text[a:b].lower())):
                    if w not in memo:
                        memo[w] = [known[g] for g in grams(w) if g in known]
                    ids += memo[w]
                found[tuple(sorted(ids))] += 1
            rows.append({"label": label, "patterns": [{"words": list(p), "n": n} for p, n in sorted(found.items())]})
        kind = pa.struct([("words", pa.list_(pa.int32())), ("n", pa.int64())])
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("label", pa.int32()), ("patterns", pa.list_(kind))]))


def document_labels(labels: DataFrame, label: str = "toxic") -> DataFrame:
    """(doc_id, label 0/1). A document with several labels is 1 if any is; others have no row."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("label in (0, 1)")
    return known.groupBy("doc_id").agg(F.max("label").alias("label"))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """(doc_id, text, label 0/1). Documents without a text or a label are left out."""
    return docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(document_labels(labels, label), "doc_id")


def _keys(texts: DataFrame) -> DataFrame:
    return texts.select("doc_id", "_row", F.length("text").alias("_chars"))


def learn(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """(doc_id, text, label) to a model; without documents of both labels, one that scores low.

    The sample is bounded in rows and characters and chosen by hash of the id; a repeated row teaches
    once. What the driver gets of it is, per document, its distinct sets of known n-grams.
    """
    hashed = with_row_hash(labelled.select("doc_id", "text", "label"))
    return _learn(of_sample(hashed, first_rows(_keys(hashed), sample_docs, SAMPLE_CHARS)))


def learn_from_labels(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_docs: int = SAMPLE_DOCS) -> Model:
    """The model of `learn(labelled_texts(docs, labels, label))`. The sample is chosen from ids and
    hashes and goes to the texts with its labels, so only texts of the sample are shuffled."""
    texts = with_row_hash(docs.select("doc_id", "text").filter(F.col("text").isNotNull()))
    known = document_labels(labels, label)
    sample = first_rows(_keys(texts).join(known, "doc_id"), sample_docs, SAMPLE_CHARS)
    return _learn(of_sample(texts, sample).join(known, "doc_id"))


def _learn(sampled: DataFrame) -> Model:
    sample = materialize(sampled.select("text", "label"), "toxic-sample")
    sizes = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model(-20.0, {})
    presence = sample.mapInArrow(_presence, "gram string, clean bigint, toxic bigint").groupBy("gram")
    presence = presence.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).filter(F.col("clean") + F.col("toxic") >= MIN_DOCS)
    n0, n1 = sizes[0], sizes[1]
    rate0, rate1 = (F.col("clean") + 0.5) / (n0 + 1.0), (F.col("toxic") + 0.5) / (n1 + 1.0)
    both = (F.col("clean") + F.col("toxic") + 0.5) / (n0 + n1 + 1.0)

    def gain(k, n, rate):
        return k * F.log(rate / both) + (n - k) * F.log((1.0 - rate) / (1.0 - both))

    told = gain(F.col("clean"), float(n0), rate0) + gain(F.col("toxic"), float(n1), rate1)
    best = presence.withColumn("told", told).orderBy(F.desc("told"), "gram").limit(8 * FEATURES).collect()
    kept = _distinct([(r.gram, r.clean, r.toxic) for r in best])[:FEATURES]
    known = {g: i for i, g in enumerate(kept)}
    rows = sample.mapInArrow(
        lambda b: _patterns(b, known), "label int, patterns array<struct<words:array<int>,n:bigint>>"
    ).collect()
    base, weights = fit([(r.label, [(tuple(p.words), p.n) for p in r.patterns]) for r in rows], len(kept))
    return Model(base, {g: float(x) for g, x in zip(kept, weights) if x != 0.0})


def _distinct(found: list[tuple[str, int, int]]) -> list[str]:
    """Without n-grams that are part of another one in the same documents."""
    alike: dict[tuple[int, int], list[str]] = {}
    for gram, *counts in found:
        alike.setdefault(tuple(counts), []).append(gram)
    return [g for g, *counts in found if not any(g != x and g in x for x in alike[tuple(counts)])]


def fit(docs: list[tuple[int, list[tuple[tuple[int, ...], int]]]], size: int) -> tuple[float, np.ndarray]:
    """Weights that maximise the noisy-or likelihood of the documents' labels, with a ridge.

    Sentences with the same known n-grams have the same probability, so a document needs each kind
    once. log(1 - p_doc) is minus the sum of softplus over its sentences.
    """
    kinds: dict[tuple[int, ...], int] = {}
    doc_at, kind_at, count = [], [], []
    for d, (_, patterns) in enumerate(docs):
        for words, n in patterns:
            doc_at.append(d)
            kind_at.append(kinds.setdefault(words, len(kinds)))
            count.append(n)
    doc_at, kind_at, count = np.array(doc_at, np.int64), np.array(kind_at, np.int64), np.array(count, float)
    word_at = np.array([w for k in kinds for w in k], np.int64)
    of_kind = np.repeat(np.arange(len(kinds)), [len(k) for k in kinds]).astype(np.int64)
    label = np.array([x for x, _ in docs], float)
    weights, base = np.zeros(size), -5.0
    moments = [np.zeros(size + 1), np.zeros(size + 1)]
    for step in range(1, STEPS + 1):
        odds = base + np.bincount(of_kind, weights[word_at], len(kinds))
        soft = np.logaddexp(0.0, odds)
        clean = np.bincount(doc_at, count * soft[kind_at], len(label))
        # d(log-likelihood)/d(sum of softplus): -1 for label 0, p/(1-p) of "all clean" for label 1.
        pull = np.where(label > 0, 1.0 / np.maximum(np.expm1(np.minimum(clean, 700.0)), 1e-12), -1.0)
        by_kind = np.bincount(kind_at, count * pull[doc_at], len(kinds)) / (1.0 + np.exp(-odds))
        slope = np.append(np.bincount(word_at, by_kind[of_kind], size) / len(label) - RIDGE * weights / len(label), by_kind.sum() / len(label))
        moments[0] = 0.9 * moments[0] + 0.1 * slope
        moments[1] = 0.99 * moments[1] + 0.01 * slope**2
        move = moments[0] / (1 - 0.9**step) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        move *= 0.1
        weights, base = weights + move[:-1], base + move[-1]
    return float(base), weights


def score_sentences(text: str | None, base: float, weight: WordWeights) -> tuple[float, list[tuple[int, int, float]]]:
    """(score of the text, [start, end, probability of each sentence with a known n-gram])."""
    spans = list(sentences(text))
    if not spans:
        return 0.0, []
    if len(weight) > MEMO_WORDS:
        weight.clear()
    soft, plain, found = 0.0, len(spans), []
    if any(weight[w] for w in set(_WORD.findall(text.lower()))):
        for a, b in spans:
            told = [x for w in sorted(set(_WORD.findall(text[a:b].lower()))) if (x := weight[w])]
            if told:
                plain -= 1
                odds = base + sum(told)
                soft += float(np.logaddexp(0.0, odds))
                found.append((a, b, float(1.0 / (1.0 + np.exp(-max(min(odds, 700.0), -700.0))))))
    soft += plain * float(np.logaddexp(0.0, base))
    return float(-np.expm1(-soft)), found


def score(docs: DataFrame, model: Model, sentence_limit: float = 0.5) -> DataFrame:
    """(doc_id, text) to (doc_id, score, spans), one row per row of `docs`.

    `score` is the noisy-or over all sentences of the whole text, 0 for null, empty or blank
    texts; `spans` are the sentences, as code point ranges [start, end) with their probability,
    that reach `sentence_limit`. Null ids and repeated rows are kept; other columns are not read.
    """
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = WordWeights(model.weights)
        for batch in batches:
            found = [score_sentences(t, model.base, weight) for t in column(batch, "text")]
            spans = [[{"start": a, "end": b, "p": p} for a, b, p in f if p >= sentence_limit] for _, f in found]
            ids = batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([s for s, _ in found], pa.float64()), pa.array(spans, pa.list_(span))], ["doc_id", "score", "spans"]
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, score double, spans array<struct<start:bigint,end:bigint,p:double>>"
    )
