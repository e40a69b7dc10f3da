"""Mixing, decontamination, token files, Katz scores and fingerprints against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from linkloom.llm import common, decontaminate, katz, mixing, queries, simhash, token_files
from linkloom.llm.queries import tokenizer_path
from tests.llm.cases import DOC_SCHEMA, collected, documents, odd_documents

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
EMPTY: list[tuple] = []


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(SMALL))


def plain_words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(SMALL))


# Running totals


def test_running_total(spark):
    rows = [(None if i % 5 == 0 else "hot" if i % 3 else "b", i % 11, i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, k int, v bigint")
    order = [F.col("k"), F.col("v")]
    got = {(r.g, r.k, r.v): r.up_to for r in common.running_total(df, ["g"], order, "v", "up_to", "bigint").collect()}
    sums = defaultdict(int)
    for g, k, v in sorted(rows, key=lambda r: (r[1], r[2])):
        sums[g] += v
        assert got[g, k, v] == sums[g]
    assert len(got) == len(rows)


# Mixing


def targets_of(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, out = share * sum(sizes.values()), {}
    while len(out) < len(sizes):
        left, open_ = total - sum(out.values()), [s for s in sizes if s not in out]
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level >= cap * sizes[s]]
        out |= {s: cap * sizes[s] for s in over} if over else {s: weight[s] * level for s in open_}
    return out


@pytest.mark.parametrize("clashing", [False, True])
def test_mix_plan(spark, clashing):
    rows = odd_documents()
    sizes = Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += len(words_of(text))
    want = targets_of(sizes)
    plan = mixing.plan_mix(documents(spark, clashing=clashing)).collect()
    assert len(plan) == len(rows)
    taken = Counter()
    largest = Counter()
    for r in plan:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r.size
        largest[r.source] = max(largest[r.source], r.size)
    for source in sizes:
        assert abs(taken[source] - want[source]) <= 1.5 * largest[source] + 1e-6
    again = mixing.plan_mix(documents(spark, clashing=clashing).repartition(7))
    assert collected(again.drop("expected")) == collected(spark.createDataFrame(plan, again.schema))


def test_copies_cross_whole_numbers(spark):
    df = spark.range(1000).select("id", F.lit("g").alias("g"), F.lit(0.37).cast(mixing.KIND).alias("e"))
    got = [r.copies for r in mixing.systematic_copies(df, "e", "g", [F.col("id")]).orderBy("id").collect()]
    assert set(got) == {0, 1} and sum(got) in (370, 371, 369)
    # Equal steps, not random draws: every run of 100 rows holds its share.
    assert all(36 <= sum(got[i : i + 100]) <= 38 for i in range(900))


def test_mix_repeats_rows(spark):
    docs = documents(spark, clashing=True)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    want = Counter()
    for r in mixing.plan_mix(docs).collect():
        if r.copies:
            want[r.doc_id, r.source, r.size] += r.copies
    got = Counter((r.doc_id, r.source, len(words_of(r.text))) for r in mixed.collect())
    assert got == want


def test_mix_keeps_the_columns_of_its_rows(spark):
    """Rows equal in id, source and text keep their own other columns; equal rows are dealt copies together."""
    rows = [(1, "a b c", lang, "s", 5) for lang in ("de", "en", "fr")] + [(2, "d e f g", "en", "s", 7)] * 4
    rows += [(i, "x " * (i % 7 + 1), "en", "t", 1) for i in range(10, 40)]
    for share in (0.4, 0.9, 1.5):
        docs = documents(spark, rows)
        planned = mixing.plan_mix(docs, text_key=common.row_key(docs), share=share)
        want = Counter()
        for r in planned.collect():
            want[r.doc_id] += r.copies
        mixed = [tuple(r) for r in mixing.mix(docs, share=share).collect()]
        assert Counter(r[0] for r in mixed) == Counter({d: n for d, n in want.items() if n})
        assert set(mixed) <= set(rows)
        langs = Counter(r[2] for r in mixed if r[0] == 1)
        assert all(abs(a - b) <= 1 for a in langs.values() for b in langs.values())


def test_mix_of_nothing(spark):
    assert mixing.plan_mix(documents(spark, EMPTY)).count() == 0
    assert mixing.mix(documents(spark, EMPTY)).count() == 0
    nothing = documents(spark, [(1, None, "en", "a", 0), (2, "", "en", None, 0)])
    assert [r.copies for r in mixing.plan_mix(nothing).collect()] == [0, 0]


# Decontamination


def leaks_of(docs, items, window=10):
    phrases = defaultdict(set)
    for item_id, text in items:
        w = plain_words_of(text)
        for i in range(max(1, len(w) - window + 1) if w and item_id is not None else 0):
            phrases[tuple(w[i : i + window])].add(str(item_id))
    out = []
    for doc_id, text, *_ in docs:
        w, hit, found = plain_words_of(text), set(), set()
        for p, owners in phrases.items():
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i : i + len(p)]) == p:
                    hit |= set(range(i, i + len(p)))
                    found |= owners
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


ITEMS = [
    (1, "One text that, a third of ALL documents share with each other"),
    (2, "the the the the the the the the the the the"),
    (3, "word"),
    (4, None),
    (5, "... !!!"),
    (6, ""),
    (7, "One text that, a third of ALL documents share with each other"),
    (None, "text without an id"),
    (10, "edge ring"),
]


@pytest.mark.parametrize("passes", [False, True])
def test_leaks(spark, monkeypatch, passes):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 150)
    if passes:
        monkeypatch.setattr(decontaminate, "PASS_WORDS", 60)
    rows = odd_documents() + [(900, " ".join(["the"] * 25), "en", "a", 1), (901, "x word y edge-ring word", "en", "a", 1)]
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumn("n", F.lit(1))
    found = decontaminate.find_leaks(documents(spark, rows, clashing=True), bench)
    assert collected(found.select("doc_id", "n_words", "n_hit", "item_ids")) == leaks_of(rows, ITEMS)


def test_items_without_id(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(decontaminate, "PASS_WORDS", 60)
    rows = odd_documents()
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    named = [(-1 if i is None else i, t) for i, t in ITEMS]
    want = [(d, n, hit, [i for i in items if i != "-1"]) for d, n, hit, items in leaks_of(rows, named)]
    found = decontaminate.find_leaks(documents(spark, rows), bench, unnamed=True)
    assert collected(found.select("doc_id", "n_words", "n_hit", "item_ids")) == sorted(want, key=repr)
    assert (None, 4, 4, []) in want
    alone = bench.filter("item_id is null")
    assert decontaminate.drop_leaks(documents(spark, rows), alone).count() == len(rows) - 1
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    alone.write.parquet(f"{tmp_path}/benchmark.parquet")
    hits = [tuple(r) for r in queries.leaks(spark, str(tmp_path)).filter("contaminated").select("doc_id", "n_hit", "n_items").collect()]
    assert hits == [(None, 4, 0)]


def test_spans_and_proximity(spark):
    docs = documents(spark, [(1, "a b c x d e f", "en", "s", 1), (2, "a b c d e f", "en", "s", 1), (3, "a b c x x x d", "en", "s", 1)])
    bench = spark.createDataFrame([(1, "b c d e")], "item_id bigint, text string")
    exact = {r.doc_id: [tuple(s) for s in r.spans] for r in decontaminate.find_leaks(docs, bench).collect()}
    assert exact == {1: [], 2: [(1, 5)], 3: []}
    near = {r.doc_id: r.n_hit > 0 for r in decontaminate.find_leaks(docs, bench, slop=1).collect()}
    assert near == {1: True, 2: True, 3: False}


def test_leaks_of_nothing(spark):
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert decontaminate.find_leaks(documents(spark, EMPTY), bench).count() == 0
    clean = decontaminate.find_leaks(documents(spark), bench.limit(0)).collect()
    assert len(clean) == len(odd_documents()) and not any(r.n_hit for r in clean)


def test_drop_leaks(spark):
    rows = odd_documents()
    bench = spark.createDataFrame(ITEMS[:2], "item_id bigint, text string")
    kept = decontaminate.drop_leaks(documents(spark, rows, clashing=True), bench)
    clean = [(d, hit) for d, _, hit, _ in leaks_of(rows, ITEMS[:2]) if not hit]
    assert kept.count() == len(clean) == len(rows) - 60
    assert "n" in kept.columns and "__leak_key" not in kept.columns


# Token files


def encoded(rows):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return [(d, tokenizer.encode(t or "", add_special_tokens=False).ids + [0]) for d, t, *_ in rows]


def test_token_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_BYTES", 2000)
    rows = odd_documents()
    dictionary, shards = token_files.write_token_files(documents(spark, clashing=True), tokenizer_path())
    read = token_files.checksums(token_files.read_token_files(dictionary, shards)).collect()
    want = Counter((d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in encoded(rows))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in read) == want
    at = 0
    for r in sorted(read, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(read, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d))
    data, width = token_files.open_dictionary(dictionary, shards)
    assert width == 2 and dictionary.first().dict_hash == hashlib.sha256(data).hexdigest()
    some = {r.doc_id: r.ids for r in token_files.read_documents(dictionary, shards, [7, 304, 12345]).collect()}
    by_id = dict(encoded(rows))
    assert {d: list(np.frombuffer(i, "<u4")) for d, i in some.items()} == {d: by_id[d] for d in (7, 304)}


def test_another_dictionary_is_refused(spark):
    dictionary, shards = token_files.write_token_files(documents(spark), tokenizer_path())
    with pytest.raises(ValueError):
        token_files.open_dictionary(dictionary.withColumn("dict_hash", F.lit("0")), shards)


def test_token_files_of_nothing(spark):
    dictionary, shards = token_files.write_token_files(documents(spark, EMPTY), tokenizer_path())
    assert token_files.read_token_files(dictionary, shards).count() == 0
    dictionary, shards = token_files.write_token_files(documents(spark, [(3, None, None, None, None)]), tokenizer_path())
    assert [tuple(r) for r in token_files.checksums(token_files.read_token_files(dictionary, shards)).collect()] == [
        (3, 0, 1, zlib.crc32(b"\0" * 4))
    ]


def test_pieces_give_the_same_ids(monkeypatch):
    monkeypatch.setattr(token_files, "MEMO_ATOMS", 50)
    rng = random.Random(3)
    bits = ["a", "It's", "the", "12", "²", "é", "×", "...", ",", "\n", "\t", " ", "  ", " ", "日本", "'s", "x.", "!?", "<|endoftext|>", "_", "\x1c"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    whole, cut = token_files.Encoder(tokenizer_path(), by_blank=False), token_files.Encoder(tokenizer_path())
    for at in range(0, len(texts), 100):
        assert cut.encode(texts[at : at + 100]) == whole.encode(texts[at : at + 100])


def test_plain_shapes_give_the_same_ids():
    rng = random.Random(4)
    words = ["Straße", "élan", "ǆ", "ɏ", "ɐ", "naïve", "ªº", "×÷", "42", "4²", "ab12", "don't", "", "ÀÖØöøÿ", "ŉ"]
    marks = ["", ".", "...", "$$$", "?!", "(*)", "-", "'", "_", "\n", ".\n", "\n\n", "\u2028", "\x85", "<|endoftext|>"]
    texts = ["".join(rng.choice(["", " ", " ", "  "]) + rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(1, 6))) for _ in range(4000)]
    whole, cut = token_files.Encoder(tokenizer_path(), by_blank=False), token_files.Encoder(tokenizer_path())
    assert cut.encode(texts) == whole.encode(texts)
    assert cut.encode(["", "a", ""]) == whole.encode(["", "a", ""]) and cut.encode([]) == []


# Katz backoff


def katz_of(rows, train):
    tokens = [words_of(t) + ["</s>"] for _, t, *_ in rows]
    uni, bi, context = Counter(), Counter(), Counter()
    for learn, words in zip(train, tokens):
        if learn:
            uni.update(words)
            for h, w in zip(["<s>", *words], words):
                bi[h, w] += 1
                context[h] += 1

    def factors(counts):
        times = Counter(counts.values())
        found = katz.discounts([times[r] for r in range(1, katz.DISCOUNTED + 2)])
        return lambda r: found[r - 1] if r <= katz.DISCOUNTED else 1.0

    total, d1, d2 = sum(uni.values()), factors(uni), factors(bi)
    kept = sum(d1(r) * r for r in uni.values())
    mass = total if kept < total else total + 1
    p = {w: d1(r) * r / mass for w, r in uni.items()}
    unknown = 1 - kept / mass
    back = {}
    for h in context:
        seen = [w for g, w in bi if g == h]
        back[h] = (1 - sum(d2(bi[h, w]) * bi[h, w] for w in seen) / (context[h] + katz.E)) / (1 - sum(p[w] for w in seen))
        own = sum(d2(bi[h, w]) * bi[h, w] / (context[h] + katz.E) for w in seen)
        rest = sum(p[w] for w in p if (h, w) not in bi) + unknown
        assert own + back[h] * rest == pytest.approx(1)
    out = []
    for (doc_id, *_), words in zip(rows, tokens):
        base = score = 0.0
        for h, w in zip(["<s>", *words], words):
            base += math.log10((uni[w] + 0.5) / (total + 0.5 * (len(uni) + 1)))
            r = bi[h, w]
            score += math.log10(d2(r) * r / (context[h] + katz.E) if r else p.get(w, unknown) * back.get(h, 1.0))
        out.append((doc_id, len(words), sum(w in uni for w in words), base, score))
    return sorted(out, key=repr), total


@pytest.mark.parametrize("small", [False, True])
def test_katz(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(katz, "BLOCK_TOKENS", 300)
    rows = odd_documents()
    train = [r[0] is not None and r[0] % 3 > 0 for r in rows]
    known = F.col("doc_id") % 3 > 0
    scored, total = katz.score(documents(spark, rows, clashing=True).withColumn("train", known))
    got = [(r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score) for r in scored.collect()]
    want, n = katz_of(rows, train)
    assert total == n
    for g, w in zip(sorted(got, key=repr), want):
        assert g[:3] == w[:3] and g[3:] == pytest.approx(w[3:], rel=1e-9, abs=1e-6)
    assert len(got) == len(want)


def test_words_are_hashed_in_pieces(monkeypatch):
    monkeypatch.setattr(katz, "PIECE_BYTES", 64)
    rng = random.Random(4)
    texts = ["", " ", "a", "  The the\tTHE\v\n", "é x " * 5, "\u00a0 \x1f", "x" * 1000 + " end", "a b", "b a", "ab"]
    texts += [" ".join(str(rng.randrange(900)) for _ in range(2000)), ""]
    hashes, lengths = katz.token_hashes([t.encode().lower() for t in texts], katz.Tables())
    assert lengths.tolist() == [len(common.blank_words(t)) + 1 for t in texts]
    hash_of = {}
    for word, h in zip([w for t in texts for w in [*common.blank_words(t), b""]], hashes.tolist()):
        assert hash_of.setdefault(word, h) == h
    assert len(set(hash_of.values())) == len(hash_of) and hash_of[b""] == katz.END
    assert katz.word_hashes([b"the", b"end"]).tolist() == [hash_of[b"the"], hash_of[b"end"]]


def test_bucket_grows_with_its_words():
    # A bucket lists the documents with a word in it, not all of the blocks that it hears of.
    def bigrams(block, doc):
        arrays = [np.array([9], "<u8"), np.array([1], "<u4"), katz._pack_contexts(np.array([5], "<u8"))]
        arrays += [np.array([1], "<u2"), np.array([doc], "<u2"), np.array([1], "<u4")]
        return ("bigrams", 0, block, arrays)

    table = katz._table(katz._packed([bigrams(block, 60_000) for block in range(50)]))
    none = np.empty(0, np.uint64)
    unigrams = katz.Unigrams(10, 5, [1] * 6)
    out = katz._score_words(table, katz._table(katz._packed([])), 8, unigrams, none, none.astype(np.int64), np.ones(5)).to_pylist()
    sums = [r for r in out if r["kind"] == "sums"]
    assert len(sums) == 50 and sum(len(d) for r in sums for d in r["data"]) < 50 * 100


def test_katz_model_is_kept_and_normalised(spark, tmp_path):
    rows = odd_documents()
    model = katz.learn(documents(spark, rows[: len(rows) // 2]))
    katz.save(model, f"{tmp_path}/model")
    opened = katz.open_model(spark, f"{tmp_path}/model")
    known = sorted(map(tuple, katz.apply(documents(spark, rows), model).collect()), key=repr)
    assert sorted(map(tuple, katz.apply(documents(spark, rows, clashing=True), opened).collect()), key=repr) == known
    words_of_context, totals = {}, {}
    for r in opened.counts.collect():
        own, n_word, runs, n = katz._read([*r.data[:3], r.data[4]], "<u8", "<i8", "<u4", "<i8")
        p_word = np.repeat(opened.unigrams.probability(n_word), runs)
        for h, p, k in zip(katz._unpack_contexts(r.data[3]).tolist(), p_word.tolist(), n.tolist()):
            words_of_context.setdefault(h, []).append((p, k))
            totals[h] = totals.get(h, 0) + k
    factors = [*opened.factors, *[1.0] * 10**4]
    seen = set()
    for r in opened.backoff.collect():
        for h, weight, total in zip(*(x.tolist() for x in katz._read(r.data, "<u8", "<f8", "<f8"))):
            assert total == totals[h]
            stored = sum(factors[k - 1] * k / (total + katz.E) for _, k in words_of_context[h])
            assert stored + weight * (1 - sum(p for p, _ in words_of_context[h])) == pytest.approx(1, abs=1e-9)
            seen.add(h)
    assert seen == set(totals) and len(seen) > 20


def test_katz_with_frequent_contexts(spark):
    rng = random.Random(12)
    rows = [(i, " ".join(f"the w{rng.randrange(60)}" for _ in range(40)), "en", "s", 1) for i in range(60)]
    rows += [(100 + i, f"the x{i} the w{i}", "en", "s", 1) for i in range(30)]
    train = [r[0] < 60 for r in rows]
    scored, total = katz.score(documents(spark, rows).withColumn("train", F.col("doc_id") < 60))
    got = {r.doc_id: (r.n_tokens, r.n_known, r.score) for r in scored.collect()}
    want, n = katz_of(rows, train)
    assert total == n and sum(t.split().count("the") for _, t, *_ in rows[:60]) > 1000
    for doc_id, n_tokens, n_known, _, score in want:
        assert got[doc_id] == (n_tokens, n_known, pytest.approx(score, abs=1e-6))
    # Unseen bigrams of one frequent context are spread, and each finds what is known of it.
    hot, reference = katz.word_hashes([b"the"]), np.arange(6400)
    the = np.repeat(hot & katz.CONTEXT_BITS, 6400)
    sent = katz._by_context("unseen", 100, hot, the, reference, np.ones(6400, "<u4"))
    known = katz._by_context("contexts", 100, hot, the[:1], np.ones(1, "<u8"))
    assert len(sent) == katz.SALTS and {r[1] for r in sent} == {r[1] for r in known}


def test_katz_without_training(spark):
    scored, total = katz.score(documents(spark).withColumn("train", F.lit(False)))
    assert total == 0 and scored.count() == len(odd_documents())
    assert katz.score(documents(spark, EMPTY).withColumn("train", F.lit(True)))[0].count() == 0


def test_discounts_fall_back():
    assert katz.discounts([0] * 6) == [0.5, 1, 1, 1, 1]
    assert all(0 < d <= 1 for d in katz.discounts([100, 40, 20, 12, 8, 5]))


# Fingerprints


def fingerprint_of(text):
    words = words_of(text)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(values, linked):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {v: find(v) for v in values}


def test_fingerprints(spark):
    for _, text, *_ in odd_documents():
        assert simhash.fingerprint(text) == fingerprint_of(text)


def test_golay_code():
    leaders = simhash._leaders()
    assert len(np.unique(leaders)) == 2048 and np.bitwise_count(leaders).max() == 3
    vectors = np.random.default_rng(1).integers(0, 1 << 23, 3000)
    words = vectors ^ leaders[simhash._remainders(vectors)]
    assert not simhash._remainders(words).any()


def near_values(rng, n):
    """Random fingerprints with neighbours one to four bits away, and a crowd around one value."""
    values = []
    for _ in range(n):
        v = rng.getrandbits(64)
        values.append(v)
        for _ in range(rng.randrange(3)):
            for b in rng.sample(range(64), rng.randint(1, 4)):
                v ^= 1 << b
            values.append(v)
    crowd = rng.getrandbits(64)
    for _ in range(120):
        v = crowd
        for b in rng.sample(range(64), rng.randint(0, 4)):
            v ^= 1 << b
        values.append(v)
    return sorted(set(values) | {0, 1, (1 << 64) - 1, 1 << 63})


@pytest.mark.parametrize("hot_key", [2, 48])
def test_links_join_all_near_fingerprints(spark, monkeypatch, hot_key):
    monkeypatch.setattr(simhash, "HOT_KEY", hot_key)
    values = near_values(random.Random(5), 150)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    linked = [(r.a, r.b) for r in simhash.links(fps).collect()]
    unsigned = lambda v: v % (1 << 64)
    assert all((unsigned(a) ^ unsigned(b)).bit_count() <= 4 for a, b in linked)
    near = [(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if (unsigned(a) ^ unsigned(b)).bit_count() <= 2]
    assert components_of(signed, linked) == components_of(signed, near)
    if hot_key == 48:
        assert set(linked) <= {tuple(sorted(p)) for p in near} | set(linked)
    rooted = {r.node: r.root for r in simhash.components(spark.createDataFrame(linked, "a bigint, b bigint")).collect()}
    want = components_of(signed, near)
    assert all(rooted.get(v, v) == want[v] for v in signed)


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a bigint, b bigint")
    rooted = {r.node: r.root for r in simhash.components(chain).collect()}
    assert rooted == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_near_duplicates(spark):
    rows = odd_documents()
    got = simhash.near_duplicates(documents(spark, clashing=True))
    fps = {i: fingerprint_of(r[1]) for i, r in enumerate(rows)}
    values = sorted(set(fps.values()))
    near = [(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b).bit_count() <= 2]
    root = components_of(values, near)
    first = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            k = root[fps[i]]
            first[k] = min(first.get(k, r[0]), r[0])
    want = sorted(((r[0], f"{fps[i]:016x}", first.get(root[fps[i]])) for i, r in enumerate(rows)), key=repr)
    assert collected(got.select("doc_id", simhash.hex_fingerprint(), "component_id")) == want
    kept = simhash.keep_first(documents(spark, clashing=True))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(first.values()))


def test_every_component_keeps_one_row(spark):
    rows = odd_documents() + [(400, "x", None, None, 1), (400, None, "x", None, 1), (None, "text without an id", "de", "src0", 18)]
    fps = [fingerprint_of(r[1]) for r in rows]
    values = sorted(set(fps))
    near = [(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b).bit_count() <= 2]
    root = components_of(values, near)
    first = {}
    for r, fp in zip(rows, fps):
        order = (r[0] is None, r[0] or 0)
        first[root[fp]] = min(first.get(root[fp], order), order)
    got = simhash.keep_one(documents(spark, rows, clashing=True))
    assert got.columns == documents(spark, rows, clashing=True).columns
    kept = [tuple(r) for r in got.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert set(kept) <= set(rows)
    assert {root[fingerprint_of(r[1])]: (r[0] is None, r[0] or 0) for r in kept} == first and len(kept) == len(first)
    again = simhash.keep_one(documents(spark, rows, clashing=True).repartition(5))
    assert collected(again) == collected(got)
    # Under one id, and under none, are texts of several groups.
    assert sorted(r[0] for r in kept if r[0] == 6) == [6, 6] and any(r[1] == "text without an id" for r in kept)
    assert simhash.keep_one(documents(spark, EMPTY)).count() == 0


def test_near_duplicates_of_nothing(spark):
    assert simhash.near_duplicates(documents(spark, EMPTY)).count() == 0
    assert simhash.keep_first(documents(spark, EMPTY)).schema.simpleString() == documents(spark, EMPTY).schema.simpleString()
    assert DOC_SCHEMA.startswith("doc_id")
