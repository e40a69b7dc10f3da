"""Spelling variants, periodic runs and document fingerprints against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.llm import periods, queries, sketches, spelling
from tests.llm.cases import DOC_SCHEMA, collected, documents, odd_documents

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def store(tmp_path, spark, rows, clashing=False):
    documents(spark, rows, clashing).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


# Spelling


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def variants_of(counts: dict) -> set:
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v.encode()), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None
    rows = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return rows


def words_of(rows) -> Counter:
    counts: Counter = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return counts


@pytest.mark.parametrize("letters", ["ab", "aé", "abcdefgh"])
def test_variants(spark, letters):
    rng = random.Random(letters)
    counts = {}
    for _ in range(150):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(1, 6)))
        counts[w] = rng.choice([1, 2, 5, 20, 20, 300, 4000, 10**12])
    got = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n bigint"))
    assert {tuple(r) for r in got.collect()} == variants_of(counts)


def test_forms_lead_to_a_root(spark):
    # Every word is ten times as frequent as the one before, so the way is as long as there are words.
    counts = {"x" * (i + 1): 10**i for i in range(17)}
    got = {r.word: (r.form, r.root) for r in spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n bigint")).collect()}
    assert {root for _, root in got.values()} == {"x" * 17}
    assert got["x"] == ("xx", "x" * 17) and got["x" * 17] == (None, "x" * 17)


def test_one_stretch_holds_a_whole_alphabet(spark):
    letters = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
    counts = {f"word{c}word": i + 1 for i, c in enumerate(letters)} | {"wordword": 5}
    assert {tuple(r) for r in spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n bigint")).collect()} == variants_of(counts)


def test_edited_words(spark):
    rows = odd_documents()
    got = spelling.edited_words(documents(spark, rows, clashing=True))
    want = words_of(rows)
    want.pop("", None)
    assert {r.word: r.n for r in got.collect()} == dict(want)


def test_words_across_slices(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SLICE_CHARS", 7)
    text = " ".join("abcdefghijklmnop"[: i % 16 + 1] for i in range(100)) + "x" * 40
    assert spelling._text_words(text) == Counter(w.encode() for w in text.split())


def test_spelling_query(spark, tmp_path):
    rows = odd_documents()
    folder = store(tmp_path, spark, rows, clashing=True)
    want = {w: n for w, n in words_of(rows).items() if len(w) >= 7 and n >= 2}
    assert {tuple(r) for r in queries.QUERIES["op11_spelling"](spark, folder).collect()} == variants_of(want)


def test_no_words(spark):
    assert spelling.variants(spelling.edited_words(documents(spark, []))).count() == 0
    assert spelling.variants(spelling.edited_words(documents(spark, [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "12", None, None, 2)]))).count() == 0


# Periodic runs


def runs_of(words, exponent, length):
    best = {}
    for p in range(1, len(words) // exponent + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(length, exponent * p) and j > i:
                best.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted(((a, b - a, p) for (a, b), p in best.items()), key=lambda r: (r[0], r[2]))


def texts_with_repeats(rng, n):
    for _ in range(n):
        words = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 70))]
        if words and rng.random() < 0.6:
            a, q = rng.randrange(len(words)), rng.randint(1, 9)
            words[a:a] = words[a : a + q] * rng.randint(2, 7)
        yield [b"%d" % w for w in words]


@pytest.mark.parametrize("exponent,length", [(2, 0), (3, 5), (4, 6)])
def test_runs(exponent, length):
    rng = random.Random(exponent)
    for _ in range(300):
        texts = list(texts_with_repeats(rng, rng.randint(1, 4)))
        for words, found in zip(texts, periods.find_runs(texts, periods.Rule(exponent, length))):
            assert [tuple(r) for r in found.tolist()] == runs_of(words, exponent, length)


@pytest.mark.parametrize("piece", [1, 2, 5])
def test_catchers_are_online(piece):
    """Words may come one at a time, and the runs so far may be asked for after each."""
    rng = random.Random(piece)
    for words in texts_with_repeats(rng, 25):
        ids, catchers = np.array([int(w) for w in words], np.int64), periods.SquareCatchers(2)
        for at in range(0, len(ids), piece):
            catchers.append(ids[at : at + piece])
            got = sorted(zip(*(c.tolist() for c in catchers.runs())))
            assert got == sorted(runs_of(ids[: at + piece].tolist(), 2, 0))


def test_a_hash_that_lies_is_found_out(monkeypatch):
    """With a tiny modulus hashes agree by chance all the time; the runs are still those of the words."""
    monkeypatch.setattr(periods, "PRIME", 101)
    drawn = 0
    for words in texts_with_repeats(random.Random(3), 200):
        ids = [int(w) for w in words]
        catchers = periods.SquareCatchers(2)
        catchers.append(np.array(ids, np.int64))
        assert sorted(zip(*(c.tolist() for c in catchers.runs()))) == sorted(runs_of(ids, 2, 0))
        drawn += catchers.seed > 1
    assert drawn


def test_long_repeats():
    texts = [[b"a"] * 50_000, [b"a", b"b", b"c"] * 20_000 + [b"d"]]
    assert [f.tolist() for f in periods.find_runs(texts, periods.Rule())] == [[[0, 50_000, 1]], [[0, 60_000, 3]]]


def period_rows(rows):
    for doc_id, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = runs_of(words, 4, 6)
        gone = {i for s, length, p in runs for i in range(s + p, s + length)}
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        yield (
            doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
        )


def test_period_query(spark, tmp_path):
    rng = random.Random(4)
    rows = [r for r in odd_documents() if r[0] != 304]
    rows += [(1000 + i, " ".join(w.decode() for w in words), "en", "s", 0) for i, words in enumerate(texts_with_repeats(rng, 150))]
    got = queries.QUERIES["op12_periods"](spark, store(tmp_path, spark, rows, clashing=True))
    assert collected(got) == sorted(period_rows(rows), key=repr)
    assert queries.QUERIES["op12_periods"](spark, store(tmp_path / "none", spark, [])).count() == 0


# Fingerprints


def likeness_of(a, b):
    a, b = (Counter(sketches.Cutter().pieces(t)) for t in (a, b))
    both = sum(a.values()) + sum(b.values())
    return 2 * sum((a & b).values()) / both if both else 1.0


def version_rows(rows):
    # Equal ids are in the order of a hash of the text; rows with equal ids are tested apart.
    texts = [(d, t or "") for d, t, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))]
    for (doc_id, text), (_, after) in zip(texts, texts[1:] + texts[:1]):
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        yield doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), likeness_of(text, new), likeness_of(text, after)


def test_fingerprint_query(spark, tmp_path):
    rows, ids = [], set()
    for r in odd_documents():
        if r[0] not in ids:
            ids.add(r[0])
            rows.append(r)
    found = queries.QUERIES["op13_fingerprints"](spark, store(tmp_path, spark, rows, clashing=True))
    kept = found.select("doc_id", "n_chars", "edited_sha256", "near_edited", "near_next")
    assert collected(kept) == sorted(version_rows(rows), key=repr)
    prints = {}
    for r, t in zip(sorted(found.collect(), key=lambda r: repr(r.doc_id)), sorted(rows, key=lambda r: repr(r[0]))):
        assert prints.setdefault(t[1] or "", r.fingerprint) == r.fingerprint
    assert len(set(prints.values())) == len(prints)


def test_rows_of_one_id(spark):
    """A third of the rows share an id or have none: each row meets exactly one other."""
    rows = [(7, f"text number {i} of the id seven", "en", "a", 0) for i in range(40)] + [(None, None, "en", "a", 0)] * 5
    rows += [(i, f"some text {i}", "en", "a", 0) for i in range(30)]
    got = sketches.versions(documents(spark, rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert Counter((r.doc_id, r.n_chars) for r in got) == Counter((r[0], len(r[1] or "")) for r in rows)


def test_one_document_and_none(spark):
    assert sketches.versions(documents(spark, [])).count() == 0
    (row,) = sketches.versions(documents(spark, [(1, "abcdef gh", "en", "a", 0)])).collect()
    assert row.near_next == 1.0 and row.edited_sha256 == hashlib.sha256(b"abcdeabcd").hexdigest()


def test_differences_are_recovered(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    pairs = []
    for i in range(60):
        left = [word() for _ in range(rng.choice([0, 3, 50, 400]))]
        right = left[:]
        for _ in range(rng.choice([0, 1, 5, 200])):
            right.insert(rng.randint(0, len(right)), rng.choice([word(), "same"]))
        pairs.append((i, " ".join(left) or None, "\n".join([" ".join(right)] * rng.choice([1, 2]))))
    cutter = sketches.Cutter()
    want = {}
    for i, a, b in pairs:
        a, b = (set(cutter.digests(t or "").tolist()) for t in (a, b))
        want[i] = [f"{x:016x}" for x in sorted(a - b)], [f"{x:016x}" for x in sorted(b - a)]
    got = sketches.changed_pieces(spark.createDataFrame(pairs, "pair_id int, text_l string, text_r string"))
    rows = got.collect()
    assert {r.pair_id: (r.only_l, r.only_r) for r in rows} == want
    assert all(r.likeness == pytest.approx(likeness_of(pairs[r.pair_id][1] or "", pairs[r.pair_id][2])) for r in rows)
    # Small differences need small tables, whatever the size of the texts.
    assert all(r.cells <= 8 for r in rows if len(r.only_l) + len(r.only_r) <= 4)
    assert any(r.cells >= 64 for r in rows)


def test_stored_fingerprints_subtract(spark):
    texts = ["one two three four five six " * 9, "one two three four five six " * 9 + "seven", "other words", ""]
    docs = documents(spark, [(i, t, "en", "a", 0) for i, t in enumerate(texts)])
    stored = {r.doc_id: bytes(r.fingerprint) for r in sketches.fingerprints(docs, 16).collect()}
    left, right = (sketches.from_bytes([stored[i] for i in ids]) for ids in ([0, 0, 3], [1, 2, 3]))
    done, found = sketches.peel(left - right)
    digests = [set(sketches.Cutter().digests(t).tolist()) for t in texts]
    assert done.all()
    for pair, (a, b) in enumerate([(0, 1), (0, 2), (3, 3)]):
        for side, want in ((1, digests[a] - digests[b]), (-1, digests[b] - digests[a])):
            assert {int(k) for t, ks, s in found for p, k, x in zip(t, ks, s) if (p, x) == (pair, side)} == want


def test_pieces_hold_the_whole_text(monkeypatch):
    texts = [t for _, t, *_ in odd_documents() if t] + [" \n lead", "x" * 1000, "tail \n"]
    assert all("".join(sketches.Cutter().pieces(t)) == t for t in texts)
    monkeypatch.setattr(sketches, "SLICE_CHARS", 50)
    assert all("".join(sketches.Cutter().pieces(t)) == t for t in texts)
