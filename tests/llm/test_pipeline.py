"""The pipeline stage by stage: what each keeps, against brute force on its own input."""

import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from linkloom.llm import language, mixing
from linkloom.llm.common import fold
from linkloom.llm.queries import tokenizer_path
from linkloom.operators.materialize import materialize
from tests.llm.test_texts import components_of, fingerprint_of, leaks_of, words_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The table before the first stage, and after each."""
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(materialize(stage(spark, docs[-1], SF), f"test-{name}"))
    return docs


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_columns(stages):
    assert all(d.columns == stages[0].columns for d in stages[1:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontaminate", "mixing", "token_files"]


def test_language_keeps_clean_documents(spark, stages):
    before, after = rows(stages[0]), rows(stages[1])
    model = language.learn(language.training_fold(stages[0], fold("doc_id")))
    want = [r for r in before if max(language.identify(r[1], model).values(), default=0) >= 0.5]
    assert Counter(after) == Counter(want) and len(after) >= 0.98 * len(before)


def test_one_document_of_each_group(stages):
    before = rows(stages[1])
    fps = {r[0]: fingerprint_of(r[1]) for r in before}
    values = sorted(set(fps.values()))
    near = [(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b).bit_count() <= 2]
    root = components_of(values, near)
    first = {}
    for d in sorted(fps):
        first.setdefault(root[fps[d]], d)
    assert sorted(r[0] for r in rows(stages[2])) == sorted(first.values())


def test_leaks_go(spark, stages):
    before = rows(stages[2])
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {d for d, _, hit, _ in leaks_of(before, items) if not hit}
    assert Counter(rows(stages[3])) == Counter(r for r in before if r[0] in clean)


def test_mix_follows_its_plan(stages):
    copies = {r.doc_id: r.copies for r in mixing.plan_mix(stages[3]).collect()}
    want = Counter({r: copies[r[0]] for r in rows(stages[3]) if copies[r[0]]})
    assert Counter(rows(stages[4])) == want
    size = {s: sum(len(words_of(r[1])) for r in rows(stages[3]) if r[3] == s) for s in {r[3] for r in want}}
    for s, total in size.items():
        assert sum(len(words_of(r[1])) * n for r, n in want.items() if r[3] == s) <= 2 * total


def test_token_files_hold_the_mix(stages):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for r in rows(stages[4]):
        ids = tokenizer.encode(r[1], add_special_tokens=False).ids + [0]
        want[r[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in stages[5].collect()) == want


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, SF).exceptAll(stages[5]).count() == 0
