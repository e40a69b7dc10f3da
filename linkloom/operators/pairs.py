"""Pairs of records and their cosine similarity.

The similarity of two records is the dot product of their unit vectors, so the unit vectors
in long form (`units`: src, rep, token, u, tail) already hold the similarity of every
pair. What a caller asks about them decides the plan:

* some given pairs      -> `score_pairs`, linear in the pairs asked for
* all pairs above a min -> `matching_pairs`, joins only the tokens that can matter
* how many pairs lie in which bin -> `indexed_bins`, scores only those near the edge of a bin
* sums over all pairs   -> `total_similarity`, `similarity_sums`, linear in the postings
* every pair sharing a token -> `sharing_pairs`, as large as its result
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.operators.kept import in_order
from linkloom.operators.materialize import materialize
from linkloom.operators.skew import BLOCK_ROWS, block_join, lookup_join

SIM_DIGITS = 12
# Room for floating-point error where a bound decides whether a pair is looked at.
SLACK = 1e-9
# Share of the smallest similarity that `candidate_pairs` may leave uncounted.
CUT_SHARE = 0.1
# Share that is added to a number before it becomes a float, which rounds by less than a tenth of it.
UPPER = 1e-6
# Kinds of tokens: in one catalogue alone, in both with at most BLOCK_ROWS rows, or with more rows.
ONE_SIDED, COLD, HOT = 0, 1, 2


def inverted_index(posted: DataFrame) -> DataFrame:
    """(token, src, id): the records that hold a token, one row each."""
    return posted.select("token", "src", "id")


def posting_counts(posted: DataFrame, left: str = "l", right: str = "r") -> DataFrame:
    """Length of each token's posting list in either catalogue."""
    return posted.groupBy("token").agg(
        F.count_if(F.col("src") == left).alias("n_left"),
        F.count_if(F.col("src") == right).alias("n_right"),
    )


def unit_vectors(weights: DataFrame, others: Sequence[str] = ()) -> DataFrame:
    """Scale each vector to length 1 and note how much of it lies in the commoner tokens.

    `weights` has (src, rep, token, df, w). `tail` is the length of the part of the unit
    vector made of this token and all tokens after it, from rare to common. The order by
    (df, token) is the same in all records, which `matching_pairs` relies on. The columns
    `others` and the squared length `norm2` may be had as well.
    """
    record = Window.partitionBy("rep", "src")
    common_first = record.orderBy(F.desc("df"), F.desc("token")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    square = F.col("w") * F.col("w")
    return (
        weights.withColumn("tail2", F.sum(square).over(common_first))
        .withColumn("norm2", F.sum(square).over(record))
        .filter("norm2 > 0")
        .select(
            "src",
            "rep",
            "token",
            (F.col("w") / F.sqrt("norm2")).alias("u"),
            F.sqrt(F.col("tail2") / F.col("norm2")).alias("tail"),
            *others,
        )
    )


def side(units: DataFrame, src: str) -> DataFrame:
    """One catalogue's unit vectors, with the column names of that side of a pair."""
    return units.filter(F.col("src") == src).select(
        F.col("rep").alias(f"{src}_rep"), "token", F.col("u").alias(f"{src}_u"), "tail"
    )


def _similarity() -> Column:
    return F.round(F.sum(F.col("l_u") * F.col("r_u")), SIM_DIGITS)


def sharing_pairs(units: DataFrame, with_tokens: bool = False) -> DataFrame:
    """Every pair with a token in common: (l_rep, r_rep, n_common, sim[, common])."""
    joined = block_join(
        side(units, "l").drop("tail"), side(units, "r").drop("tail"), ["token"], "l_rep", "r_rep"
    )
    measures = [F.count("*").alias("n_common"), _similarity().alias("sim")]
    if with_tokens:
        measures.append(F.sort_array(F.collect_list("token")).alias("common"))
    return joined.groupBy("l_rep", "r_rep").agg(*measures)


def _band(tail: Column) -> Column:
    """b with 4**-(b+1) < tail <= 4**-b, never too high for rounding."""
    return F.greatest(F.floor(-F.log(tail) / math.log(4) - SLACK), F.lit(0)).cast("int")


def candidate_pairs(units: DataFrame, min_sim: float) -> DataFrame:
    """A small superset of the pairs with similarity of at least `min_sim` > 0.

    Walk through the common tokens of a pair from rare to common. By Cauchy-Schwarz, those
    from one token on add at most the product of the two tails at that token. Tails shrink
    along the way, so once the product is below a `cut`, all that follows adds less than
    `cut`. Common tokens with a smaller product are therefore left out, and a pair can reach
    `min_sim` only if the others add up to `min_sim - cut`.

    A common word has a small weight and a small tail in almost every record, so it hardly
    ever takes part. To keep the join itself from trying such rows, each tail is put into a
    band of powers of four, and left rows go only to the right bands that can reach `cut`.
    """
    left, right, cut, slack = _banded(side(units, "l"), side(units, "r"), min_sim)
    joined = block_join(left, right, ["token", "band"], "l_rep", "r_rep")
    return _candidates(joined, min_sim, cut, slack).select("l_rep", "r_rep")


def _banded(left: DataFrame, right: DataFrame, min_sim: float) -> tuple[DataFrame, DataFrame, float, float]:
    """Both sides' rows that can still matter, each with its band, and the cut and its slack."""
    # A share of the cut, so that it stays positive for however small a similarity.
    slack = min(SLACK, min_sim * CUT_SHARE / 2)
    cut = min_sim * CUT_SHARE - slack
    top = math.floor(-math.log(cut) / math.log(4) + SLACK)
    left, right = (
        rows.filter(F.col("tail") >= cut).withColumnRenamed("tail", f"{src}_tail")
        for src, rows in (("l", left), ("r", right))
    )
    left = left.withColumn(
        "band", F.explode(F.sequence(F.lit(0), F.greatest(top - _band(F.col("l_tail")), F.lit(0))))
    )
    return left, right.withColumn("band", _band(F.col("r_tail"))), cut, slack


def _candidates(joined: DataFrame, min_sim: float, cut: float, slack: float) -> DataFrame:
    return (
        joined.filter(F.col("l_tail") * F.col("r_tail") >= cut)
        .groupBy("l_rep", "r_rep")
        .agg(F.sum(F.col("l_u") * F.col("r_u")).alias("part"))
        .filter(F.col("part") >= min_sim - cut - 2 * slack)
    )


def upper(x: Column) -> Column:
    """A float that is not less than a positive double: half the space where a bound will do."""
    return (x * (1 + UPPER)).cast("float")


@dataclass(frozen=True)
class Index:
    """Unit vectors as kept tables, by record and by token.

    kept_l, kept_r  a row a record, as `vectors` makes it, bucketed by rep
    both_l, both_r  rep, token_hash, upper bounds of u and tail: the COLD tokens, bucketed by token_hash

    Tokens of one catalogue alone are in the vectors only, as no pair shares them. Two tokens of
    the same hash would make an upper bound looser and nothing else; where a lower one is wanted,
    `tokens` (token, n_rows, n_right) tells whether there are any, and `groups` (src, rep) which ids have several texts.
    """

    kept_l: DataFrame
    kept_r: DataFrame
    both_l: DataFrame | None = None
    both_r: DataFrame | None = None
    tokens: DataFrame | None = None
    groups: DataFrame | None = None

    @property
    def vec_l(self) -> DataFrame:
        """rep, and arrays of token, u, tail (an upper bound) and kind."""
        return with_u(self.kept_l)

    @property
    def vec_r(self) -> DataFrame:
        return with_u(self.kept_r)

    @property
    def units(self) -> DataFrame:
        """The unit vectors in long form, with `kind`."""
        return long_form(self.kept_l, "l").unionByName(long_form(self.kept_r, "r"))

    @property
    def hot(self) -> DataFrame:
        """src, rep, token, u, tail of tokens with more than BLOCK_ROWS rows."""
        return long_form(self.kept_l, "l", HOT).unionByName(long_form(self.kept_r, "r", HOT)).drop("kind")

    @property
    def cold_l(self) -> DataFrame:
        return self._cold("l")

    @property
    def cold_r(self) -> DataFrame:
        return self._cold("r")

    def _cold(self, src: str) -> DataFrame:
        return self.units.filter((F.col("kind") != HOT) & (F.col("src") == src)).drop("kind", "src")


def long_form(kept_vectors: DataFrame, src: str, kind: int | None = None) -> DataFrame:
    """Kept vectors of a catalogue, or their tokens of a kind, to (src, rep, token, u, tail, kind).

    Arrays are read by place: zipped ones, and lambdas, would keep Spark from compiling the step.
    """
    each = kept_vectors.withColumn("_words", F.split("words", " ")).select("*", F.posexplode_outer("kind").alias("_at", "_kind"))
    each = each.filter(F.col("_kind").isNotNull() if kind is None else F.col("_kind") == kind)
    n, df, tail2, token = (F.get(c, "_at") for c in ("n", "df", "tail2", "_words"))
    length = F.coalesce(F.get("lens", "_at"), F.get("lens", F.lit(0)))
    u = _kept_u(n / length, df, "norm2").alias("u")
    return each.select(F.lit(src).alias("src"), "rep", token.alias("token"), u, _kept_tail(tail2).alias("tail"), F.col("_kind").alias("kind"))


def token_kind(n_rows: Column, n_right: Column) -> Column:
    one_sided = (n_right == 0) | (n_right == n_rows)
    return F.when(n_rows > BLOCK_ROWS, HOT).when(one_sided, ONE_SIDED).otherwise(COLD).cast("tinyint")


def vectors(weighed: DataFrame, src: str) -> DataFrame:
    """(rep, token, n, len, df, kind, n_records) of a catalogue, dealt by record, to one row a record.

    rep, n_records, norm2    the number of all records, and the vector's squared length before it is a unit vector
    words, n, df, kind       its tokens, common ones first, as one string, and an array of each number
    lens                     the record's number of tokens, once; one a token where an id has texts of several lengths
    tail2                    the squared length made of a token and those before it, as an upper bound

    Of `u` the numbers it comes from are kept, which take a quarter of its space. A row is written several times as fast as
    with an array of words. Squares are summed up once: the last sum is the whole vector's.
    """
    w = F.col("n") / F.col("len") * (F.col("n_records") / F.col("df"))
    common_first = Window.partitionBy("rep").orderBy(F.desc("df"), F.desc("token")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    entry = F.struct("token", "n", "len", "df", "kind", "tail2", upper(F.col("tail2")).alias("bound"))
    one_row = weighed.withColumn("tail2", F.sum(w * w).over(common_first)).groupBy("rep").agg(
        F.any_value("n_records").alias("n_records"),
        F.max("tail2").alias("norm2"),
        (F.min("len") == F.max("len")).alias("_one"),
        F.collect_list(entry).alias("_all"),
    )
    every = F.col("_all")
    return one_row.filter("norm2 > 0").select(
        "rep",
        "n_records",
        "norm2",
        F.array_join(every["token"], " ").alias("words"),
        F.when(F.col("_one"), F.slice(every["len"], 1, 1)).otherwise(every["len"]).alias("lens"),
        *[every[c].alias(c) for c in ("n", "df", "kind")],
        every["bound"].alias("tail2"),
    )


def _kept_u(tf: Column, df: Column, norm2: str) -> Column:
    return tf * (F.col("n_records") / df) / F.sqrt(norm2)


def _kept_tail(tail2: Column) -> Column:
    return F.sqrt(tail2.cast("double") / F.col("norm2"))


def _term_frequencies(n: str, lens: str) -> Column:
    """The array of n / len of a kept vector."""
    single = F.transform(n, lambda x: x / F.get(lens, F.lit(0)))
    return F.when(F.size(lens) == 1, single).otherwise(F.zip_with(n, lens, lambda x, length: x / length))


def with_u(kept_vectors: DataFrame) -> DataFrame:
    """The vectors with `u` and `tail` as arrays."""
    u = F.zip_with(_term_frequencies("n", "lens"), "df", lambda tf, df: _kept_u(tf, df, "norm2")).alias("u")
    tail = F.transform("tail2", _kept_tail).alias("tail")
    return kept_vectors.select("rep", F.split("words", " ").alias("token"), u, tail, "kind")


def token_hash(token: Column | str) -> Column:
    return F.xxhash64(token)


def hashes_differ(tokens: DataFrame) -> bool:
    """Whether no two COLD tokens have the same hash."""
    cold = tokens.filter(token_kind(F.col("n_rows"), F.col("n_right")) == COLD)
    return cold.groupBy(token_hash("token").alias("_hash")).agg(F.count("*").alias("n")).filter("n > 1").isEmpty()


def ids_differ(groups: DataFrame) -> bool:
    """Whether no id of a catalogue stands for several texts."""
    return groups.groupBy("src", "rep").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()


def words_differ(vectors: DataFrame) -> bool:
    """Whether no vector holds a word twice, as that of an id with several texts may; tails are no bounds then."""
    return vectors.filter(F.size(F.array_distinct("token")) < F.size("token")).isEmpty()


def shared_rows(kept_vectors: DataFrame) -> DataFrame:
    """(rep, token_hash, u, tail) of the COLD tokens, `u` and `tail` as upper bounds."""
    rows = long_form(kept_vectors, "", COLD)
    return rows.select("rep", token_hash("token").alias("token_hash"), *[upper(F.col(c)).alias(c) for c in ("u", "tail")])


def shared_counts(tokens: DataFrame) -> dict[str, int]:
    """How many rows `shared_rows` has for either catalogue, where ids are unique."""
    cold = tokens.filter(token_kind(F.col("n_rows"), F.col("n_right")) == COLD)
    rows = cold.agg(F.sum(F.col("n_rows") - F.col("n_right")).alias("l"), F.sum("n_right").alias("r")).first()
    return {"l": rows.l or 0, "r": rows.r or 0}


def indexed_candidates(index: Index, min_sim: float) -> DataFrame:
    """As `candidate_pairs`. Tokens with few rows are joined bucket by bucket, without an exchange.

    A row of theirs meets at most BLOCK_ROWS others, so they need no bands to keep such tries few;
    making those would have the rows exchanged.
    """
    return _indexed_parts(index, min_sim)[0].select("l_rep", "r_rep")


def _indexed_parts(index: Index, min_sim: float) -> tuple[DataFrame, float]:
    """Candidates with `part`, what the tokens that were looked at come to at most, and the cut: what all others are below."""

    def named(rows: DataFrame, src: str) -> DataFrame:
        bounds = [F.col(c).cast("double").alias(f"{src}_{c}") for c in ("u", "tail")]
        return rows.select(F.col("rep").alias(f"{src}_rep"), "token_hash", *bounds)

    hot = index.hot
    hot_l, hot_r, cut, slack = _banded(side(hot, "l"), side(hot, "r"), min_sim)
    left, right = (
        named(rows, src).filter(F.col(f"{src}_tail") >= cut) for src, rows in (("l", index.both_l), ("r", index.both_r))
    )
    matters = F.col("l_tail") * F.col("r_tail") >= cut
    joined = left.join(right.withColumnRenamed("token_hash", "_hash"), (F.col("token_hash") == F.col("_hash")) & matters)
    hot_l, hot_r = materialize(hot_l, "hot-l"), materialize(hot_r, "hot-r")
    common = block_join(hot_l, hot_r, ["token", "band"], "l_rep", "r_rep")
    columns = ["l_rep", "l_u", "l_tail", "r_rep", "r_u", "r_tail"]
    return _candidates(joined.select(columns).unionByName(common.select(columns)), min_sim, cut, slack), cut


def indexed_bins(index: Index, min_sim: float, bin_of: Callable[[Column], Column]) -> DataFrame:
    """(l_rep, r_rep, bin): the pairs of `indexed_matches`, with the bin of their similarity alone.

    What is known of a candidate leaves its similarity a range a little wider than the cut. `bin_of` must not
    fall where the similarity rises, so a range with both ends in one bin lies in it as a whole. Only the
    vectors of the other pairs are looked up, and those pairs are scored.
    """
    if not min_sim > 0:
        raise ValueError("min_sim must be positive")
    parts, cut = _indexed_parts(index, min_sim)
    # `part` is made of two upper bounds a token. SLACK is far more than what rounding to SIM_DIGITS changes.
    low, high = F.col("part") * (1 - 3 * UPPER) - SLACK, F.col("part") + cut + SLACK
    # Two tokens of one hash would count as common where they are not.
    bounded = hashes_differ(index.tokens) and (ids_differ(index.groups) or words_differ(index.vec_l) and words_differ(index.vec_r))
    known = (bin_of(low) == bin_of(high)) & (low >= min_sim) & F.lit(bounded)
    with in_order(parts.sparkSession):
        found = materialize(parts.select("l_rep", "r_rep", F.when(known, bin_of(low)).alias("bin")), "pair-bins")
    scored = indexed_scores(found.filter("bin is null"), index).filter(F.col("sim") >= min_sim)
    return found.filter("bin is not null").unionByName(scored.select("l_rep", "r_rep", bin_of(F.col("sim")).alias("bin")))


def attach_bucketed(rows: DataFrame, table: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Inner join of rows with a table that is bucketed by `key` and has one row for each.

    The table is not moved. Keys with more than BLOCK_ROWS rows are taken apart: their rows of
    the table are repeated for every block of rows, and joined by key and block.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > BLOCK_ROWS)
    hot = materialize(counts.withColumn("_blocks", F.ceil(F.col("_rows") / BLOCK_ROWS).cast("int")), "hot-keys")
    if hot.isEmpty():
        return rows.join(table, key)
    marked = lookup_join(rows, hot, [key], "_rows", spread_by).drop("_rows")
    cold = marked.filter("_blocks is null").drop("_blocks").join(table, key)
    repeated = table.join(hot, key).withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).drop("_rows", "_blocks")
    warm = marked.filter("_blocks is not null").withColumn("_block", F.pmod(F.xxhash64(spread_by), F.col("_blocks")).cast("int"))
    return cold.unionByName(warm.drop("_blocks").join(repeated, [key, "_block"]).select(*cold.columns))


def indexed_scores(pairs: DataFrame, index: Index) -> DataFrame:
    """As `score_pairs`: whole vectors are looked up by record and multiplied inside the row.

    The left ones are moved to the right ones, with their words, which have no blanks, as one string. `u` is made
    of those tokens alone that both have, whose `df` is the same.
    """
    with in_order(pairs.sparkSession):
        pairs = materialize(pairs.select("l_rep", "r_rep"), "asked-pairs")
    left = index.kept_l.select(F.col("rep").alias("l_rep"), *[F.col(c).alias(f"l_{c}") for c in ("words", "n", "lens", "norm2")])
    right = index.kept_r.select(F.col("rep").alias("r_rep"), "words", "n", "lens", "df", "norm2", "n_records")
    both = attach_bucketed(attach_bucketed(pairs, left, "l_rep", "r_rep"), right, "r_rep", "l_rep")
    tokens = lambda words, values: F.map_from_arrays(F.split(words, " "), values)
    found = F.map_zip_with(
        tokens("l_words", _term_frequencies("l_n", "l_lens")),
        tokens("words", F.arrays_zip(_term_frequencies("n", "lens").alias("tf"), "df")),
        lambda _, l, r: F.when(l.isNotNull() & r.isNotNull(), _kept_u(l, r["df"], "l_norm2") * _kept_u(r["tf"], r["df"], "norm2")),
    )
    products = F.map_values(found)
    measures = F.struct(
        F.size("_products").cast("bigint").alias("n_common"),
        F.round(F.aggregate("_products", F.lit(0.0), lambda a, x: a + x), SIM_DIGITS).alias("sim"),
    )
    # As a row made of the products: a condition on plain columns would go into the join, which would multiply once more.
    scored = both.select("l_rep", "r_rep", F.filter(products, lambda x: x.isNotNull()).alias("_products"))
    return scored.select("l_rep", "r_rep", F.inline_outer(F.array(measures))).filter("n_common > 0")


def score_pairs(pairs: DataFrame, units: DataFrame) -> DataFrame:
    """Similarity of the given (l_rep, r_rep) pairs that share a token, each pair once."""
    left, right = side(units, "l").drop("tail"), side(units, "r").drop("tail")
    return (
        block_join(pairs.select("l_rep", "r_rep"), left, ["l_rep"], "r_rep", "token")
        .transform(lambda half: block_join(half, right, ["r_rep", "token"], "l_rep", "r_rep"))
        .groupBy("l_rep", "r_rep")
        .agg(F.count("*").alias("n_common"), _similarity().alias("sim"))
    )


def matching_pairs(units: DataFrame, min_sim: float) -> DataFrame:
    """Exactly the pairs with similarity of at least `min_sim` > 0."""
    if not min_sim > 0:
        raise ValueError("min_sim must be positive; use sharing_pairs for all pairs")
    candidates = materialize(candidate_pairs(units, min_sim), "candidates")
    return score_pairs(candidates, units).filter(F.col("sim") >= min_sim)


def indexed_matches(index: Index, min_sim: float) -> DataFrame:
    """As `matching_pairs`."""
    if not min_sim > 0:
        raise ValueError("min_sim must be positive; use sharing_pairs for all pairs")
    return indexed_scores(indexed_candidates(index, min_sim), index).filter(F.col("sim") >= min_sim)


def centroid(units: DataFrame, groups: DataFrame, src: str) -> DataFrame:
    """Sum of the unit vectors of all records of a catalogue: (token, total)."""
    sizes = groups.filter(F.col("src") == src).select("rep", "n_records")
    return (
        units.filter(F.col("src") == src)
        .join(sizes, "rep")
        .groupBy("token")
        .agg(F.sum(F.col("u") * F.col("n_records")).alias("total"))
    )


def total_similarity(units: DataFrame, groups: DataFrame) -> DataFrame:
    """One row: the sum of the similarities of all pairs, without forming a pair.

    The sum over all pairs of dot products is the dot product of the two sums of vectors.
    """
    left = centroid(units, groups, "l").withColumnRenamed("total", "l_total")
    right = centroid(units, groups, "r").withColumnRenamed("total", "r_total")
    return left.join(right, "token").agg(
        F.coalesce(F.sum(F.col("l_total") * F.col("r_total")), F.lit(0.0)).alias("total")
    )


def similarity_sums(units: DataFrame, groups: DataFrame) -> DataFrame:
    """(l_rep, total): the sum of a left record's similarities to all right records."""
    left_counts = units.filter("src = 'l'").groupBy("token").agg(F.count("*").alias("n_rows"))
    lookup = materialize(centroid(units, groups, "r").join(left_counts, "token"), "centroid")
    return (
        lookup_join(side(units, "l"), lookup, ["token"], "n_rows", "l_rep", "inner")
        .groupBy("l_rep")
        .agg(F.sum(F.col("l_u") * F.col("total")).alias("total"))
    )
