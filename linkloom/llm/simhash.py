"""SimHash near-duplicates, found through Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits. Two fingerprints that differ in
at most two bits have a segment without any difference (pigeonhole), and at most two differing
bits in the segment after it. The perfect Golay code (23, 12) turns the latter into equality: the
vectors within one bit of a segment decode to one codeword or to six, and two segments at
distance two have a vector between them that is within one bit of both. So each fingerprint gets,
for each of the three segments, the segment itself with each codeword of the next one as a key:
35 bits, 3 to 18 keys. Equal keys are joined and the true distance checked.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import blank_words, column, row_key
from linkloom.operators.materialize import materialize
from linkloom.operators.skew import lookup_join

SHINGLE = 3
MAX_BITS = 2
SEED = 42
# First bit and width of each segment; the last is filled up with zeros to 23 bits.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
# Fixed value: a generator polynomial of the Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1.
GENERATOR = 0b110001110101
# Keys with more fingerprints than this are linked through the vectors between them.
HOT_KEY = 48


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit by bit the majority of the XXH64 of all word shingles; 0 without words."""
    words = blank_words(text)
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(itertools.islice(words, i, None) for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), "<u8")
    # Unpacked in slices: 64 bytes per shingle.
    ones = sum(
        np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        for at in range(0, len(hashes), 65536)
    )
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, beside: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text) to (doc_id, fp bigint, the 64 bits as a signed number), and the bigint columns
    `beside` them as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t, shingle) for t in column(batch, "text")], np.uint64)
            ids = batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64())
            more = [batch.column(batch.schema.get_field_index(c)) for c in beside]
            yield pa.RecordBatch.from_arrays([ids, pa.array(values.view(np.int64)), *more], ["doc_id", "fp", *beside])

    schema = ", ".join(f"{c} bigint" for c in ("doc_id", "fp", *beside))
    return docs.select("doc_id", "text", *beside).mapInArrow(run, schema)


def _remainders(vectors: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit polynomial by the generator."""
    left = vectors.astype(np.int64)
    for bit in range(22, 10, -1):
        left = np.where(left >> bit & 1, left ^ (GENERATOR << (bit - 11)), left)
    return left


def _leaders() -> np.ndarray:
    """The error of at most three bits for each remainder: the code is perfect, so each has one."""
    errors = np.array(
        [sum(1 << b for b in bits) for n in range(4) for bits in itertools.combinations(range(23), n)], np.int64
    )
    table = np.empty(1 << 11, np.int64)
    table[_remainders(errors)] = errors
    return table


def codewords(vectors: np.ndarray, leaders: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword nearest to each 23-bit vector."""
    return (vectors ^ leaders[_remainders(vectors)]) >> 11


def keys_of(fps: np.ndarray, leaders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) pairs, each once: the keys of each fingerprint."""
    rows, keys = [], []
    segments = [(fps >> np.uint64(first) & np.uint64((1 << width) - 1)).astype(np.int64) for first, width in SEGMENTS]
    for number, exact in enumerate(segments):
        after = (number + 1) % len(SEGMENTS)
        flips = np.array([0, *(1 << b for b in range(SEGMENTS[after][1]))], np.int64)
        near = codewords((segments[after][:, None] ^ flips).ravel(), leaders).reshape(len(fps), -1)
        near.sort(axis=1)
        fresh = np.ones(near.shape, bool)
        fresh[:, 1:] = near[:, 1:] != near[:, :-1]
        row, at = np.nonzero(fresh)
        rows.append(row)
        keys.append(number << 40 | exact[row] << 12 | near[row, at])
    return np.concatenate(rows), np.concatenate(keys)


def golay_keys(fps: DataFrame) -> DataFrame:
    """(fp) to (key, fp), 3 to 18 rows for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaders = _leaders()
        for batch in batches:
            values = batch.column(0).to_numpy()
            for at in range(0, len(values), 4096):
                some = values[at : at + 4096]
                row, key = keys_of(some.view(np.uint64), leaders)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(some[row])], ["key", "fp"])

    return fps.select("fp").mapInArrow(run, "key bigint, fp bigint")


def links(fps: DataFrame) -> DataFrame:
    """(a, b) with a < b: links that connect all fingerprints at MAX_BITS or fewer, directly or
    through each other, and no others.

    A key of up to HOT_KEY fingerprints is joined with itself and each pair verified. The
    fingerprints of a larger one are dealt out once more, each with the 64 vectors one bit away
    and itself: those that meet at a vector are at most two bits apart, and any two at most two
    bits apart meet at one. There, each is linked to the least, so m of them give m-1 links.
    """
    keys = materialize(golay_keys(fps), "golay-keys")
    sizes = materialize(keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "golay-sizes")
    few = keys.join(sizes.filter(F.col("n") <= HOT_KEY).select("key"), "key")
    left, right = few.select("key", F.col("fp").alias("a")), few.select("key", F.col("fp").alias("b"))
    near = left.join(right, "key").filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS))
    near = near.select("a", "b")
    hot = sizes.filter(F.col("n") > HOT_KEY)
    if not hot.isEmpty():
        crowded = lookup_join(keys, hot, ["key"], "n", "fp", "inner").select("fp").distinct()
        crowded = materialize(crowded, "crowded")
        flips = F.array(F.lit(0).cast("bigint"), *[F.lit(np.int64(np.uint64(1 << b)).item()) for b in range(64)])
        between = crowded.select("fp", F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("mid"))
        least = between.groupBy("mid").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1")
        near = near.unionByName(between.join(least, "mid").filter("a < fp").select("a", F.col("fp").alias("b")))
    return near.distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the least node reachable over the edges, for every node of an edge.

    Alternates two kinds of rounds until nothing changes: each node's larger neighbours are
    hung to its least one, then its smaller ones. Every round is written, so that the plan does
    not grow and a lost executor costs one round. Rounds grow with the logarithm of the longest
    chain. A node's least neighbour is an aggregate, so a star of any size is summed in parts.
    """
    pairs = materialize(edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).filter("u < v").distinct(), "edges")
    before = None
    while True:
        both = pairs.unionAll(pairs.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"), F.count("*").alias("n"))
        large = lookup_join(both.filter("u > v"), materialize(least, "least"), ["v"], "n", "u", "inner")
        pairs = materialize(large.select(F.col("u").alias("v"), F.col("m").alias("u")).filter("u < v").distinct(), "large-star")
        least = pairs.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("n"))
        small = lookup_join(pairs, materialize(least, "least"), ["v"], "n", "u", "inner")
        small = small.select(F.col("u").alias("v"), F.col("m").alias("u")).unionAll(small.select("v", F.col("m").alias("u")))
        pairs = materialize(small.filter("u < v").distinct(), "small-star")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    nodes = pairs.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return nodes.unionAll(pairs.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


def _rooted(found: DataFrame, *aggregates: Column) -> DataFrame:
    """(…, fp) to the written table (fp, root, *aggregates), one row per fingerprint; root is the
    least fingerprint of its component."""
    groups = materialize(found.groupBy("fp").agg(*aggregates), "fp-groups")
    linked = materialize(components(links(groups)), "fp-components")
    rooted = groups.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return materialize(rooted, "fp-roots")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id): one row per row of `docs`.

    Documents are linked when their fingerprints differ in at most MAX_BITS bits; component_id is
    the least doc_id reachable over links. Copies share a fingerprint, and fingerprints are
    compared once each, however many documents have them. A null or empty text has fingerprint 0
    and is linked like any other. Repeated rows get the same component; a null id takes part and
    gets its component's id, which is null if no document there has one. Other columns are not
    looked at.
    """
    found = materialize(fingerprints(docs, shingle), "fingerprints")
    rooted = _rooted(found, F.min("doc_id").alias("first"), F.count("*").alias("n_docs"))
    # Components of one fingerprint need no lookup.
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("n_fps"))
    named = lookup_join(rooted, materialize(ids, "component-ids"), ["root"], "n_fps", "fp", "inner")
    named = materialize(named.select("fp", "n_docs", "component_id"), "fp-named")
    return lookup_join(found, named, ["fp"], "n_docs", "doc_id", "inner").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: str = "fp"):
    """The 64 bits as 16 hexadecimal digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def keep_first(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The document with the least id of each component, all columns kept; each id once, even if it
    stands for several components. `keep_one` has a row for each of them."""
    groups = near_duplicates(docs, shingle)
    kept = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    kept = materialize(kept.select(F.col("doc_id").alias("__kept_id")), "kept")
    joined = docs.join(kept, docs["doc_id"].eqNullSafe(kept["__kept_id"]), "left_semi")
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    # Texts are dealt out by id once more only where some id has several rows.
    return joined if repeated.isEmpty() else joined.dropDuplicates(["doc_id"])


def keep_one(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row of each component, all columns kept: the one with the least id, of several with that
    id the one with the least hash of its columns. A null id comes after all others.

    Rows are known by their id and that hash, so rows of one id and unlike texts are apart, and rows
    that share both are copies, of which one stays.
    """
    keyed = docs.withColumn("__row_key", row_key(docs))
    found = materialize(fingerprints(keyed, shingle, ("__row_key",)), "fingerprints")
    rooted = _rooted(found, F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row_key")).alias("first"))
    first = rooted.groupBy("root").agg(F.min("first").alias("first"))
    kept = materialize(first.select(F.col("first.doc_id").alias("__kept_id"), F.col("first.__row_key").alias("__kept_key")), "kept")
    same = keyed["doc_id"].eqNullSafe(kept["__kept_id"]) & (keyed["__row_key"] == kept["__kept_key"])
    joined = keyed.join(kept, same, "left_semi")
    repeated = found.groupBy("doc_id", "__row_key").agg(F.count("*").alias("n")).filter("n > 1")
    # Texts are dealt out once more only where some row is repeated.
    if not repeated.isEmpty():
        joined = joined.dropDuplicates(["doc_id", "__row_key"])
    return joined.select(*docs.columns)
