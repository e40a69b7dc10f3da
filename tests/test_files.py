"""Files of lines read once, stopwords from a table, any thresholds, estimates beside exact values."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from linkloom import queries
from linkloom.functions.sets import hash_family
from linkloom.functions.stopwords import STOPWORDS
from linkloom.operators import evaluate, sets, tokens
from linkloom.operators.materialize import write_lines
from linkloom.operators.running import running_sums
from linkloom.operators.skew import HOT_KEYS
from linkloom.sources import lines

SF = "/root/testdata/sf0.01"


def feed_of(spark, values, read):
    return read(spark, write_lines(spark.createDataFrame([(v,) for v in values], "value string").repartition(3), "lines"))


def test_a_feed_is_read_once(spark):
    good = [f'"id{i}","title {i}",,"maker",{i}' for i in range(50)]
    bad = ["no fields at all", "", '"a",b,c,d,e', "ünï"]
    feed = feed_of(spark, ['"id","title","description","manufacturer","price"', *good, *bad], lines.read_record_feed)
    assert feed.counts == {"ok": 50, "header": 1, "failed": 4}
    assert Counter(r.text for r in feed.accepted.collect()) == Counter(f"title {i}  \"maker\"" for i in range(50))
    assert sorted(r.value for r in feed.rejected.collect()) == sorted(bad)
    assert {r.status: r.n for r in lines.feed_counts(spark, feed).collect()} == feed.counts


def test_one_scan_gives_records_and_counts(spark):
    path = write_lines(spark.createDataFrame([('"a","b",c,d,1',)], "value string"), "lines")
    feed = lines.load(lines.parse_record_lines(lines.read_lines(spark, path)), "feed")
    for df in (feed.accepted, feed.rejected):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan and "FileScan text" not in plan
    assert sum(feed.counts.values()) == 1


def test_an_empty_file(spark):
    feed = feed_of(spark, [], lines.read_record_feed)
    assert feed.counts == {"ok": 0, "header": 0, "failed": 0}
    assert feed.accepted.count() == feed.rejected.count() == lines.feed_counts(spark, feed).count() == 0


def test_gold_files(spark):
    feed = feed_of(spark, ['"idAmazon","idGoogleBase"', '"a","b"', '"a","b"', "a;b", '"c","d"'], lines.read_gold_feed)
    assert Counter((r.l_id, r.r_id) for r in feed.accepted.collect()) == {("a", "b"): 2, ("c", "d"): 1}
    assert [r.value for r in feed.rejected.collect()] == ["a;b"]


def test_csv_keeps_what_the_regex_splits_wrongly_and_what_it_cannot_read(spark):
    values = ['"id","title","description","manufacturer","price"', '"1","ti, tle","x ""y"", z","a,b",3', '"2","t",,,', '"3","t"', '"4","t",,,1,2']
    feed = feed_of(spark, values, lines.read_csv_feed)
    assert {r.id: r.text for r in feed.accepted.collect()} == {"1": 'ti, tle x "y", z a,b', "2": "t  "}
    assert sorted(r.value for r in feed.rejected.collect()) == ['"3","t"', '"4","t",,,1,2']
    assert feed.counts == {"ok": 2, "header": 1, "failed": 2}
    path = write_lines(spark.createDataFrame([(v,) for v in values], "value string").coalesce(1), "lines")
    regex = {r.id: r.text for r in lines.read_records(spark, path).collect()}
    assert regex.get("1") != 'ti, tle x "y", z a,b'


@pytest.mark.parametrize("limit", [0, 5, 1000])
def test_stopword_table_equals_list(spark, limit):
    """Broadcast or joined by token, with a word that holds most rows, is null, or no stopword."""
    rng = random.Random(limit)
    words = ["the"] * 50 + ["pop", "of", "rare", "a"] + list("uvwxyz")
    recs = [("l", i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for i in range(80)]
    rows = tokens.token_rows(tokens.tokenize(spark.createDataFrame(recs, "src string, id bigint, text string"), stopwords=()))
    stop = spark.createDataFrame([(w,) for w in [*STOPWORDS, "the", None]], "token string")
    got = tokens.drop_stopword_rows(rows, stop, limit=limit)
    want = tokens.token_rows(tokens.tokenize(spark.createDataFrame(recs, "src string, id bigint, text string")))
    assert got.columns == rows.columns
    assert Counter((r.id, r.token) for r in got.collect()) == Counter((r.id, r.token) for r in want.collect())
    none = tokens.drop_stopword_rows(rows, stop.limit(0), limit=limit)
    assert none.count() == rows.count()


def test_long_stopword_lists_are_not_broadcast(spark):
    rows = spark.range(1000).select("id", F.concat(F.lit("w"), F.col("id")).alias("token"))
    stop = spark.range(500).select(F.concat(F.lit("w"), F.col("id") * 2).alias("token"))
    got = tokens.drop_stopword_rows(rows, stop, limit=10)
    assert got.count() == 500 and HOT_KEYS >= 1000


@pytest.mark.parametrize("parts", [1, 5])
def test_running_sums(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.randrange(40), i, rng.randrange(9)) for i in range(400)]
    df = spark.createDataFrame(rows, "a int, b int, n bigint").repartition(parts)
    got = {r.b: r.n_before for r in running_sums(df, ["a", "b"], ["n"]).collect()}
    total = 0
    for _, b, n in sorted(rows):
        assert got[b] == total
        total += n
    assert running_sums(df.limit(0), ["a", "b"], ["n"]).count() == 0


def test_rates_at_any_threshold(spark):
    rng = random.Random(2)
    every = [round(rng.random() ** 2, 3) for _ in range(300)] + [0.0, 1.0, 0.5, 0.5]
    gold = rng.sample(every, 60) + [0.29, 0.29]
    every += [0.29, 0.29]
    thresholds = [0.0, 0.005, 0.29, 0.2900001, 0.5, 1 / 3, 1.0, 1.5, -2.0, *gold[:10]]
    sims = spark.createDataFrame([(s,) for s in every], "sim double")
    gold_sims = spark.createDataFrame([(s,) for s in gold], "sim double")
    asked = spark.createDataFrame([(t,) for t in [*thresholds, None, 0.5]], "threshold double")
    got = {r.threshold: r for r in evaluate.rates_at(asked, evaluate.similarity_histogram(sims), gold_sims).collect()}
    assert set(got) == set(thresholds)
    bins = Counter(int(s * 100 // 1) for s in every)
    bins.subtract(int(s * 100 // 1) for s in gold)
    for t in thresholds:
        tp, fn = sum(s >= t for s in gold), sum(s < t for s in gold)
        fp = sum(n for b, n in bins.items() if b / 100 >= t)
        r = got[t]
        assert (int(r.tp), int(r.fn), int(r.fp)) == (tp, fn, fp)
        assert r.precision == (pytest.approx(tp / (tp + fp)) if tp + fp else None)
        assert r.recall == pytest.approx(tp / (tp + fn))


def test_rates_agree_with_the_curve(spark):
    sims = spark.range(1, 2000).select((F.pmod(F.xxhash64("id"), F.lit(1000)) / 999).alias("sim"))
    gold = sims.filter("sim > 0.3").limit(100)
    histogram = evaluate.similarity_histogram(sims)
    curve = evaluate.threshold_curve(histogram, gold)
    at = evaluate.rates_at(curve.select("threshold"), histogram, gold)
    columns = ["threshold", "tp", "fp", "fn"]
    assert {tuple(map(float, r)) for r in at.select(columns).collect()} == {tuple(map(float, r)) for r in curve.select(columns).collect()}


def test_estimate_beside_exact_value(spark):
    rows = queries.minhash_error(spark, SF).filter("estimate is not null").collect()
    assert len({r.jaccard for r in rows}) > 10 and any(0 < r.jaccard < 1 for r in rows)
    assert sum(r.error for r in rows) / len(rows) < 0.05


def test_estimate_of_known_sets(spark):
    text = lambda a, b: " ".join(f"w{i}" for i in range(a, b))
    pairs = [(1, text(0, 400), text(200, 600)), (2, text(0, 50), text(0, 50)), (3, text(0, 9), ""), (4, "", None), (5, text(0, 9), text(20, 40))]
    got = {r.pair_id: r for r in sets.text_pair_minhash(spark.createDataFrame(pairs, "pair_id int, text_l string, text_r string"), hash_family(400)).collect()}
    assert got[1].jaccard == pytest.approx(1 / 3) and got[1].error < 0.05
    assert (got[2].jaccard, got[2].estimate, got[2].n_equal) == (1.0, 1.0, 400)
    assert (got[3].jaccard, got[3].estimate, got[4].jaccard, got[4].estimate) == (0.0, None, None, None)
    assert (got[5].jaccard, got[5].estimate) == (0.0, 0.0)


def test_element_matrix_and_back(spark):
    """More sets than a block has columns, an element in all of them, sets that are empty or repeat an element."""
    rng = random.Random(8)
    rows = [(3 * i, sorted(rng.sample(range(30), rng.randint(0, 6))) + [77, 77] * (i != 5)) for i in range(150)] + [(500, [])]
    sets_of = spark.createDataFrame(rows, "id bigint, elements array<bigint>").repartition(4)
    columns = sets.matrix_columns(sets_of)
    assert {r.id: r.column for r in columns.collect()} == {d: i for i, (d, _) in enumerate(sorted(rows))}
    matrix = sets.element_matrix(sets_of, columns)
    got = {(r.element, r.block): r.v for r in matrix.collect()}
    assert all(len(v) == 64 and "1" in v for v in got.values())
    place = {d: i for i, (d, _) in enumerate(sorted(rows))}
    want = {(e, place[d]) for d, es in rows for e in es}
    assert {(e, b * 64 + i) for (e, b), v in got.items() for i, bit in enumerate(v) if bit == "1"} == want
    back = Counter((r.id, r.element) for r in sets.matrix_sets(matrix, columns).collect())
    assert back == Counter({(d, e) for d, es in rows for e in es})
    hashes = hash_family(16)
    long = sets_of.select("id", F.explode("elements").alias("element"))
    by_set = {r.id: r.signature for r in sets.minhash(long, hashes).collect()}
    by_matrix = {r.column: r.signature for r in sets.matrix_minhash(matrix, hashes).collect()}
    assert by_matrix == {place[d]: s for d, s in by_set.items()}
    assert sets.element_matrix(sets_of.limit(0), sets.matrix_columns(sets_of.limit(0))).count() == 0
