"""Sets, bags and MinHash signatures as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.sets import apply_hash, equal_positions, jaccard_bag, jaccard_set, merged_bags, token_number
from linkloom.functions.stopwords import STOPWORDS
from linkloom.functions.text import kept_tokens, with_bag
from linkloom.operators.running import running_sums
from linkloom.operators.skew import lookup_join
from linkloom.operators.tokens import postings

# Columns of an element matrix that stand in one row: the bits of a bigint.
MATRIX_WIDTH = 64

Hashes = Sequence[tuple[int, int, int, int]]


def indicator_to_set(vectors: DataFrame) -> DataFrame:
    """(id, v array of 0/1) to (id, element): the positions that are set."""
    return (
        vectors.select("id", F.posexplode_outer("v").alias("element", "bit"))
        .filter("bit = 1")
        .select("id", F.col("element").cast("bigint").alias("element"))
    )


def matrix_to_vectors(matrix: DataFrame) -> DataFrame:
    """(row, v) with one column per document to (id, element): the set of each column."""
    return (
        matrix.select(F.col("row").alias("element"), F.posexplode_outer("v").alias("id", "bit"))
        .filter("bit = 1")
        .select("id", F.col("element").cast("bigint").alias("element"))
    )


def matrix_columns(ids: DataFrame) -> DataFrame:
    """(id, column): the ids, each once, numbered from 0 in their order; nulls are left out."""
    one = ids.select("id").filter("id is not null").distinct().withColumn("one", F.lit(1).cast("bigint"))
    return running_sums(one, ["id"], ["one"]).select("id", F.col("one_before").alias("column"))


def element_matrix(sets: DataFrame, columns: DataFrame) -> DataFrame:
    """(id, elements array) to (element, block, v): one column a set, one row an element.

    A whole row would have as many entries as there are sets, so it is cut into blocks of
    MATRIX_WIDTH columns; `v` holds the 0 and 1 of one block as a string. Blocks without a 1 are
    left out. An element in very many sets fills many rows, none of them longer than others.
    """
    # The outer form, or else Spark tests the size of the arrays before, and makes them once more for that.
    placed = sets.join(columns, "id").select("column", F.explode_outer("elements").alias("element")).filter("element is not null")
    # A block's columns are the bits of one number while it is put together.
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("column", F.lit(MATRIX_WIDTH)).cast("int"))
    block = F.floor(F.col("column") / MATRIX_WIDTH).cast("bigint").alias("block")
    rows = placed.select("element", block, bit.alias("_bit")).groupBy("element", "block").agg(F.bit_or("_bit").alias("_bits"))
    return rows.select("element", "block", F.reverse(F.lpad(F.bin("_bits"), MATRIX_WIDTH, "0")).alias("v"))


def _cells(matrix: DataFrame) -> DataFrame:
    """(column, element) of the 1s."""
    bits = matrix.select("element", "block", F.posexplode(F.split("v", "")).alias("at", "bit")).filter("bit = '1'")
    return bits.select((F.col("block") * MATRIX_WIDTH + F.col("at")).alias("column"), "element")


def matrix_sets(matrix: DataFrame, columns: DataFrame) -> DataFrame:
    """(element, block, v) back to (id, element), one row for each 1."""
    return _cells(matrix).join(columns, "column").select("id", "element")


def matrix_minhash(matrix: DataFrame, hashes: Hashes) -> DataFrame:
    """(element, block, v) to (column, signature): as `minhash`, for columns that have a 1."""
    return minhash(_cells(matrix).withColumnRenamed("column", "id"), hashes).withColumnRenamed("id", "column")


def minhash(elements: DataFrame, hashes: Hashes) -> DataFrame:
    """(id, element) to (id, signature): per hash function the least value over the set.

    Each function is one aggregate, so a row stays one row and every task reduces its part
    of a set before the shuffle, however large the set is. A set without elements has none.
    """
    minima = [F.min(apply_hash(F.col("element"), m, b, p)).alias(f"h{i}") for i, m, b, p in hashes]
    return elements.groupBy("id").agg(*minima).select(
        "id", F.array(*[f"h{i}" for i, *_ in hashes]).alias("signature")
    )


def record_signatures(bagged: DataFrame, hashes: Hashes) -> DataFrame:
    """(src, id, bag) to (src, id, signature), of each record with tokens, through the long form.

    A repeated id has a signature for each of its records, so a record is known by its place as well.
    """
    record = F.struct("src", "id", F.monotonically_increasing_id().alias("place"))
    rows = postings(bagged.select(record.alias("id"), "bag"))
    signed = minhash(rows.select("id", token_number("token").alias("element")), hashes)
    return signed.select("id.src", "id.id", "signature")


def signature_values(signatures: DataFrame) -> DataFrame:
    """(id, signature) to (id, hash_no, minhash)."""
    return signatures.select("id", F.posexplode("signature").alias("hash_no", "minhash"))


def signature_rows(values: DataFrame) -> DataFrame:
    """(id, hash_no, minhash) back to (id, signature), ordered by hash function."""
    ordered = F.array_sort(F.collect_list(F.struct("hash_no", "minhash")))
    return values.groupBy("id").agg(F.transform(ordered, lambda s: s["minhash"]).alias("signature"))


def attach_sides(requests: DataFrame, left: DataFrame, right: DataFrame, value: str) -> DataFrame:
    """Add `l_<value>` and `r_<value>` of both records to each requested (l_id, r_id).

    An id may be asked for many times, so each lookup spreads the requests of hot ids.
    """
    out = requests
    for prefix, table, other in (("l", left, "r_id"), ("r", right, "l_id")):
        counts = requests.groupBy(f"{prefix}_id").agg(F.count("*").alias("_rows"))
        lookup = table.select(
            F.col("id").alias(f"{prefix}_id"), F.col(value).alias(f"{prefix}_{value}")
        ).join(counts, f"{prefix}_id")
        out = lookup_join(out, lookup, [f"{prefix}_id"], "_rows", other, "inner").drop("_rows")
    return out


def compare_signatures(pairs: DataFrame) -> DataFrame:
    """(l_signature, r_signature) to the number of equal positions and their share."""
    return (
        pairs.withColumn("n_equal", equal_positions("l_signature", "r_signature").cast("bigint"))
        .withColumn("estimate", F.col("n_equal") / F.size("l_signature"))
        .drop("l_signature", "r_signature")
    )


def bagged_pairs(pairs: DataFrame, stopwords: Sequence[str] = STOPWORDS) -> DataFrame:
    """(pair_id, text_l, text_r) to (pair_id, bag_l, bag_r)."""
    both = pairs.withColumn("tokens_l", kept_tokens("text_l", stopwords)).withColumn(
        "tokens_r", kept_tokens("text_r", stopwords)
    )
    both = with_bag(both, F.col("tokens_l"), "bag_l")
    return with_bag(both, F.col("tokens_r"), "bag_r").select(
        "pair_id", "bag_l", "bag_r", F.size("tokens_l").alias("len_l"), F.size("tokens_r").alias("len_r")
    )


def text_pair_jaccard(pairs: DataFrame, stopwords: Sequence[str] = STOPWORDS) -> DataFrame:
    """Set and bag overlap of the two texts of each row, without a shuffle."""
    bagged = bagged_pairs(pairs, stopwords)
    return bagged.select(
        "pair_id",
        jaccard_set(bagged["bag_l"]["token"], bagged["bag_r"]["token"]).alias("jaccard_set"),
        jaccard_bag("bag_l", "bag_r").alias("jaccard_bag"),
    )


def text_pair_minhash(pairs: DataFrame, hashes: Hashes, stopwords: Sequence[str] = STOPWORDS) -> DataFrame:
    """(pair_id, jaccard, n_equal, estimate, error): the MinHash estimate beside what it estimates.

    The exact value is found inside the row and goes along with either text's signature, of which
    nothing but minima is shuffled. A pair with a text without tokens has no estimate, as that text
    has no signature.
    """
    bagged = bagged_pairs(pairs, stopwords)
    words = {side: bagged[f"bag_{side}"]["token"] for side in ("l", "r")}
    sides = F.array(*[F.struct(F.lit(side).alias("side"), tokens.alias("tokens")) for side, tokens in words.items()])
    sided = bagged.select("pair_id", jaccard_set(words["l"], words["r"]).alias("jaccard"), F.explode(sides).alias("s"))
    rows = sided.select(F.struct("pair_id", "jaccard", "s.side").alias("id"), F.explode_outer("s.tokens").alias("token"))
    signatures = minhash(rows.select("id", token_number("token").alias("element")), hashes)
    signed = signatures.groupBy("id.pair_id", "id.jaccard").agg(
        *[F.max(F.when(F.col("id.side") == side, F.col("signature"))).alias(f"{side}_signature") for side in words]
    )
    signed = signed.withColumn("_both", F.get("l_signature", 0).isNotNull() & F.get("r_signature", 0).isNotNull())
    compared = compare_signatures(signed)
    estimate = F.when(F.col("_both"), F.col("estimate"))
    return compared.select(
        "pair_id",
        "jaccard",
        F.when(F.col("_both"), F.col("n_equal")).alias("n_equal"),
        estimate.alias("estimate"),
        F.abs(estimate - F.col("jaccard")).alias("error"),
    )


def text_pair_cosine(pairs: DataFrame, idf: DataFrame, stopwords: Sequence[str] = STOPWORDS) -> DataFrame:
    """Cosine similarity of the two texts of each row, weighed by a given IDF table.

    The texts need not belong to the corpus of `idf`; unknown tokens weigh 0. A pair with a
    text of weight 0 has no similarity (NULL).
    """
    # A pair without any token keeps one row. Its made-up key, unlike a NULL, is spread evenly
    # by the join below, and matches nothing because a token has no blank.
    no_token = F.concat(F.lit(" "), F.col("pair_id").cast("string"))
    tokens = (
        bagged_pairs(pairs, stopwords)
        .select("pair_id", "len_l", "len_r", F.explode_outer(merged_bags("bag_l", "bag_r")).alias("token", "n"))
        .select(
            "pair_id",
            F.coalesce("token", no_token).alias("token"),
            F.try_divide(F.col("n.l"), F.col("len_l")).alias("tf_l"),
            F.try_divide(F.col("n.r"), F.col("len_r")).alias("tf_r"),
        )
    )
    weighed = lookup_join(tokens, idf, ["token"], "df", "pair_id")
    idf_value = F.coalesce("idf", F.lit(0.0))
    w_l, w_r = (F.coalesce(F.col(f"tf_{s}") * idf_value, F.lit(0.0)) for s in ("l", "r"))
    sums = weighed.groupBy("pair_id").agg(
        F.sum(w_l * w_r).alias("dot"), F.sum(w_l * w_l).alias("l2"), F.sum(w_r * w_r).alias("r2")
    )
    return sums.select(
        "pair_id", F.round(F.try_divide(F.col("dot"), F.sqrt("l2") * F.sqrt("r2")), 12).alias("sim")
    )
