"""Small cases with known results.

Fixed values: the texts, lines, matrices and numbers below that must come out as they stand.
"""

import pytest
from pyspark.sql import functions as F

from linkloom.functions import sets as set_functions
from linkloom.functions.stopwords import STOPWORDS
from linkloom.functions.text import kept_tokens, tokens
from linkloom.operators import evaluate, pairs, sets, weights
from linkloom.operators.tokens import bags, biggest_record, postings, records, token_total, tokenize
from linkloom.sources import lines


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values))
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text, expected",
    [
        ("", []),
        (
            "This 88 is! a,Test! The result !!!should be: 8 Words",
            ["8", "88", "a", "be", "is", "result", "should", "test", "the", "this", "words"],
        ),
        (
            "This is another test. It contains a lot of words which are also in string 1.",
            "1 a also another are contains in is it lot of string test this which words".split(),
        ),
        ("!!123A!/456_B_12/987C.123d", ["123a", "123d", "456_b_12", "987c"]),
        ("Größe", ["e", "gr"]),
    ],
)
def test_tokens(spark, text, expected):
    assert sorted(one(spark, tokens("t"), t=text)) == expected


def test_stopwords(spark):
    assert len(set(STOPWORDS)) == 127
    assert sorted(one(spark, kept_tokens("t"), t="Being at the top of the pops!")) == ["pops", "top"]
    assert one(spark, kept_tokens("t"), t="red the red") == ["red", "red"]


def _tokenized(spark, rows):
    df = spark.createDataFrame(rows, "src string, id bigint, text string")
    return tokenize(df, stopwords=())


def test_term_frequency(spark):
    rows = [("l", 1, "This is test Test and this is another test test."), ("l", 2, "")]
    tf = weights.term_frequency(postings(bags(_tokenized(spark, rows))))
    assert {r.token: r.tf for r in tf.collect()} == {
        "test": 0.4, "this": 0.2, "is": 0.2, "another": 0.1, "and": 0.1
    }


def test_totals(spark):
    tokenized = _tokenized(spark, [("l", 1, "a b"), ("l", 2, "a b c"), ("r", 3, "d e f"), ("r", 4, "")])
    assert {r.src: r.n_tokens for r in token_total(tokenized).collect()} == {"l": 5, "r": 3}
    assert biggest_record(tokenized).first().id == 2
    assert token_total(tokenized.filter("false")).collect() == []


def test_idf_counts_records_without_tokens(spark):
    recs = spark.createDataFrame([("l", 1, "x y"), ("l", 2, "x"), ("r", 3, "")], "src string, id bigint, text string")
    idf = weights.idf_table(postings(bags(tokenize(recs, ()))), recs)
    assert {r.token: r.idf for r in idf.collect()} == {"x": 1.5, "y": 3.0}


def test_tfidf_of_unknown_tokens_is_zero(spark):
    posted = postings(bags(_tokenized(spark, [("l", 1, "known unknown")])))
    idf = spark.createDataFrame([("known", 2, 4.0)], "token string, df bigint, idf double")
    assert {r.token: r.w for r in weights.tfidf(posted, idf).collect()} == {"known": 2.0, "unknown": 0.0}


def _weights(spark, left, right):
    rows = [("l", 1, t, 1, w) for t, w in left.items()] + [("r", 2, t, 1, w) for t, w in right.items()]
    return spark.createDataFrame(rows, "src string, rep bigint, token string, df bigint, w double")


def test_norm(spark):
    w = _weights(spark, {"a": 4.0, "c": 5.0, "b": 7.0}, {}).withColumnRenamed("rep", "id")
    none = spark.createDataFrame([("r", 9, 0)], "src string, id bigint, len int")
    norms = {r.id: r.norm for r in weights.norms(w, none).collect()}
    assert norms[1] == pytest.approx(9.486832980505)
    assert norms[9] == 0.0


def test_dot_product(spark):
    w = _weights(spark, {"a": 4.0, "c": 5.0, "b": 7.0}, {"a": 2.0, "b": 50.0, "d": 100.0})
    sim = pairs.sharing_pairs(pairs.unit_vectors(w), with_tokens=True).first()
    assert sim.sim * (90**0.5) * (12504**0.5) == pytest.approx(358)
    assert (sim.n_common, sim.common) == (2, ["a", "b"])


def test_cosine(spark):
    w = _weights(spark, {"a": 4.0, "c": 5.0, "b": 7.0}, {"a": 5.0, "c": 2.0, "e": 7.0})
    units = pairs.unit_vectors(w)
    assert pairs.sharing_pairs(units).first().sim == pytest.approx(0.35805743701971)
    assert pairs.matching_pairs(units, 0.3).first().sim == pytest.approx(0.35805743701971)
    assert pairs.matching_pairs(units, 0.36).count() == 0


def test_inverted_index(spark):
    posted = spark.createDataFrame(
        [("hello", "l", t) for t in ("dies", "ist", "ein", "Test")], "id string, src string, token string"
    )
    found = {(r.token, r.id) for r in pairs.inverted_index(posted).collect()}
    assert found == {("dies", "hello"), ("ist", "hello"), ("ein", "hello"), ("Test", "hello")}


BAG_1 = "this is a test this is a test hello world".split()
BAG_2 = "this is a test this is a test cat dog".split()


def test_jaccard(spark):
    assert one(spark, set_functions.jaccard_set("a", "b"), a=BAG_1, b=BAG_2) == 0.5
    empty = F.array().cast("array<string>")
    assert one(spark, set_functions.jaccard_set(empty, empty), a=BAG_1) is None
    both = spark.createDataFrame(
        [(1, " ".join(BAG_1), " ".join(BAG_2)), (2, "a a a", "a"), (3, "a", "a a a"), (4, "", "")],
        "pair_id int, text_l string, text_r string",
    )
    found = {r.pair_id: r.jaccard_bag for r in sets.text_pair_jaccard(both, ()).collect()}
    assert found == {1: 0.4, 2: 0.75, 3: 0.25, 4: None}


def test_text_pair_cosine(spark):
    idf = spark.createDataFrame(
        [("adobe", 2, 10.0), ("photoshop", 4, 5.0), ("illustrator", 1, 20.0)], "token string, df bigint, idf double"
    )
    texts = spark.createDataFrame(
        [(1, "Adobe Photoshop", "Adobe Illustrator"), (2, "the", "of"), (3, "unheard", "adobe")],
        "pair_id int, text_l string, text_r string",
    )
    found = {r.pair_id: r.sim for r in sets.text_pair_cosine(texts, idf).collect()}
    assert found[1] == pytest.approx(100 / ((125**0.5) * (500**0.5)))
    assert found[2] is None and found[3] is None


LECTURE = [(1, 1, 5), (3, 1, 5)]
MATRIX = [[1, 0, 0, 1], [0, 0, 1, 0], [0, 1, 0, 1], [1, 0, 1, 1], [0, 0, 1, 0]]


def test_minhash_lecture_example(spark):
    matrix = spark.createDataFrame(list(enumerate(MATRIX)), "row int, v array<int>")
    hashes = [(i, *h) for i, h in enumerate(LECTURE)]
    signed = sets.minhash(sets.matrix_to_vectors(matrix), hashes)
    by_doc = {r.id: r.signature for r in signed.collect()}
    assert [[by_doc[d][h] for d in range(4)] for h in range(2)] == [[1, 3, 0, 1], [0, 2, 0, 0]]
    assert {r.id: r.signature for r in sets.signature_rows(sets.signature_values(signed)).collect()} == by_doc


def test_compare_signatures(spark):
    a, b = [2, 1, 1, 0, 1, 1, 0, 6, 1, 4, 0, 1], [3, 0, 1, 1, 0, 1, 1, 0, 1, 0, 1, 1]
    assert one(spark, set_functions.equal_positions("a", "b"), a=a, b=b) == 4


def test_hash_family():
    family = set_functions.hash_family(400)
    assert len({(m, b) for _, m, b, _ in family}) == 400
    with pytest.raises(ValueError):
        set_functions.hash_family(5, prime=5)


def test_minhash_estimate_is_close(spark):
    size, hashes = 10_000, set_functions.hash_family(400, prime=10_007)
    bits = spark.range(size).select(
        "id", (F.pmod(F.xxhash64("id"), F.lit(10)) < 5).alias("a"), (F.pmod(F.xxhash64("id"), F.lit(10)) < 7).alias("b")
    )
    elements = bits.filter("a").select(F.lit("a").alias("id"), F.col("id").alias("element")).unionAll(
        bits.filter("b").select(F.lit("b").alias("id"), F.col("id").alias("element"))
    )
    signed = {r.id: r.signature for r in sets.minhash(elements, hashes).collect()}
    n = {r.id: r["count"] for r in elements.groupBy("id").count().collect()}
    estimate = sum(x == y for x, y in zip(signed["a"], signed["b"])) / 400
    assert abs(n["a"] / n["b"] - estimate) < 0.05
    arrays = elements.groupBy("id").agg(F.collect_list("element").alias("e"))
    in_row = arrays.select("id", set_functions.signature(F.col("e"), hashes).alias("s"))
    assert {r.id: r.s for r in in_row.collect()} == signed


def test_indicator_to_set(spark):
    vectors = spark.createDataFrame([("x", [0, 1, 1]), ("y", [0, 0, 0])], "id string, v array<int>")
    assert {(r.id, r.element) for r in sets.indicator_to_set(vectors).collect()} == {("x", 1), ("x", 2)}


RECORD_LINES = [
    '"id","title","description","manufacturer","price"',
    '"b000jz4hqo","clickart 950 000 - premier image pack (dvd-rom)",,"broderbund",0',
    '"id1","title","a, b, c","manu",9.5',
    '"id1","title","a "", x","manu",9.5',
    '"id1","ti, tle","desc","m,n",9.5',
    "id,no quotes,at all,x,1",
    "",
]


def test_record_lines(spark, tmp_path):
    path = tmp_path / "records.csv"
    path.write_text("\n".join(RECORD_LINES) + "\n")
    parsed = lines.parse_record_lines(lines.read_lines(spark, str(path)))
    assert {r.status: r.n for r in lines.status_counts(parsed).collect()} == {"ok": 4, "header": 1, "failed": 2}
    got = {(r.id, r.text) for r in lines.read_records(spark, str(path)).collect()}
    assert ("b000jz4hqo", 'clickart 950 000 - premier image pack (dvd-rom)  "broderbund"') in got
    # The first group of the line pattern is greedy, so some ids swallow the next field.
    assert {i for i, _ in got} == {"b000jz4hqo", "id1", "id1,title", "id1,ti, tle"}
    assert {r.value for r in lines.rejects(parsed).collect()} == {"id,no quotes,at all,x,1", ""}
    assert lines.reject_sample(parsed, 1).count() == 1
    csv = {r.id: r.text for r in lines.read_record_csv(spark, str(path)).filter("id = 'b000jz4hqo'").collect()}
    assert csv["b000jz4hqo"] == "clickart 950 000 - premier image pack (dvd-rom)  broderbund"


def test_gold_lines(spark, tmp_path):
    path = tmp_path / "gold.csv"
    pair = '"b000jz4hqo","http://example.org/1"'
    path.write_text("\n".join(['"idAmazon","idGoogleBase"', pair, pair, "broken"]))
    assert [tuple(r) for r in lines.read_gold(spark, str(path)).collect()] == [("b000jz4hqo", "http://example.org/1")]


def test_stopword_file(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text("the\nof\nthe\n")
    assert {r.token for r in lines.read_stopwords(spark, str(path)).collect()} == {"the", "of"}


def test_curve_by_hand(spark):
    sims = spark.createDataFrame(
        [(1, 1, 0.29), (1, 2, 0.5), (2, 2, 1.0), (3, 3, 0.004)], "l_id int, r_id int, sim double"
    )
    gold = spark.createDataFrame([(2, 2), (1, 1), (9, 9), (2, 2)], "l_id int, r_id int")
    gold_sims = evaluate.gold_similarity(gold, sims)
    assert {(r.l_id, r.sim) for r in gold_sims.collect()} == {(2, 1.0), (1, 0.29), (9, 0.0)}
    assert {r.l_id for r in evaluate.duplicates(sims, gold).collect()} == {1, 2}
    assert {(r.l_id, r.r_id) for r in evaluate.non_duplicates(sims, gold).collect()} == {(1, 2), (3, 3)}
    histogram = evaluate.similarity_histogram(sims)
    # 0.29 * 100 is just below 29, so the value belongs to bin 28.
    assert {r.bin: r.n for r in histogram.collect()} == {28: 1, 50: 1, 100: 1, 0: 1}
    fp = {r.bin: r.n for r in evaluate.false_positive_bins(histogram, gold_sims).collect()}
    assert fp == {28: 0, 50: 1, 100: 0, 0: 0}
    curve = {round(r.threshold * 100): r for r in evaluate.threshold_curve(histogram, gold_sims).collect()}
    assert len(curve) == 100
    # False negatives compare the exact value: 0.29 is not below 0.29.
    assert (curve[29].tp, curve[29].fn, curve[29].fp) == (2, 1, 1)
    assert (curve[30].tp, curve[30].fn, curve[30].fp) == (1, 2, 1)
    assert (curve[51].fp, curve[100].tp, curve[100].fn) == (0, 1, 2)
    assert curve[100].precision == 1.0 and curve[100].recall == pytest.approx(1 / 3)
    assert curve[100].f == pytest.approx(0.5)


def test_ratios_without_counts(spark):
    counts = spark.createDataFrame([(0, 0, 0)], "tp bigint, fp bigint, fn bigint")
    row = evaluate.with_ratios(counts).first()
    assert row.precision is None and row.recall is None and row.f is None


def test_records(spark):
    df = spark.createDataFrame([(7, "x")], "key int, body string")
    assert records(df, "l", "key", "body").first().asDict() == {"src": "l", "id": 7, "text": "x"}
