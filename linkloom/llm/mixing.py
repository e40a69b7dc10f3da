"""Mixing sources to target weights by systematic sampling.

Each source gets a target size. A document's expected number of copies is its source's target
over its source's size. Within a source the expected copies are summed up from document to
document, a random offset below one is added, and a document is taken once for each whole
number that the sum passes at it. So every document is taken the expected number of times,
rounded down or up, and documents of like size stand side by side, which keeps a source's
taken words within about one document of its target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import row_key, running_total
from linkloom.operators.materialize import materialize
from linkloom.operators.skew import lookup_join

WORDS = r"[^\x20\x09-\x0D]+"
# Expected copies and their sums: decimals, so that sums do not depend on their order.
KIND = "decimal(30,15)"


def word_count(text: str = "text") -> Column:
    """Runs of characters other than blank and tab to carriage return; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint")


def source_targets(
    sources: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0
) -> DataFrame:
    """(source, source_size, ...) to the same with `target`.

    Sources in code point order, null last, weigh `weights` in turn. Together they get `share`
    of all sizes by weight, but none more than `cap` times its size: the excess goes to the
    others by weight until none is above. Each round of that is one aggregate over the written
    source table; a source once at its cap stays there, so there are at most as many rounds as
    sources, and a handful in practice. With share > cap every source ends at its cap.
    """
    ranked = running_total(
        sources.withColumn("_one", F.lit(1).cast("bigint")),
        [],
        [F.col("source").asc_nulls_last()],
        "_one",
        "_rank",
        "bigint",
    )
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int")
    )
    ranked = materialize(
        ranked.select(*sources.columns, weight.alias("_weight"), (F.col("source_size") * F.lit(float(cap))).alias("_cap")),
        "source-weights",
    )
    total = float(ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]) * share
    level = 0.0
    while True:
        # Who is above its cap at this level stays at the cap; the others share the rest.
        capped = F.col("_weight") * F.lit(level) >= F.col("_cap")
        spent, open_weight = ranked.agg(
            F.coalesce(F.sum(F.when(capped, F.col("_cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~capped, F.col("_weight"))), F.lit(0.0)),
        ).first()
        if not open_weight:
            break
        risen = (total - spent) / open_weight
        if risen <= level * (1 + 1e-12):
            break
        level = risen
    target = F.least(F.col("_cap"), F.col("_weight") * F.lit(level)) if open_weight else F.col("_cap")
    return ranked.withColumn("target", target).drop("_weight", "_cap")


def systematic_copies(
    docs: DataFrame, expected: str, group: str, order: Sequence[Column], seed: int = 42
) -> DataFrame:
    """Add `copies`: how many whole numbers the running sum of `expected` passes at a row.

    The sum starts, for each group, at an offset in [0, 1) drawn from the seed and the group.
    """
    summed = running_total(docs, [group], order, expected, "_up_to", KIND)
    drawn = F.pmod(F.xxhash64(F.lit(seed), F.coalesce(F.col(group).cast("string"), F.lit("\u0000null"))), F.lit(1 << 30))
    offset = (drawn.cast("decimal(20,0)") / F.lit(1 << 30).cast("decimal(20,0)")).cast(KIND)
    upper, lower = F.col("_up_to") + offset, F.col("_up_to") - F.col(expected) + offset
    return summed.withColumn("copies", (F.floor(upper) - F.floor(lower)).cast("bigint")).drop("_up_to")


def plan_mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 42,
    text_key: Column | None = None,
) -> DataFrame:
    """(doc_id, source, text) to (doc_id, source, size, source_size, target, copies, text_key).

    One row per input row, repeated rows included. Only ids, sizes and a hash of the text are
    moved, never texts; `text_key`, a hash of the text if it is not given, tells rows of the same
    id apart. A null or empty text has
    size 0 and may be taken, which adds no words; a source without any words has target 0, and
    nothing of it is taken. A null source is a source of its own; a null id is an id.
    """
    text_key = F.xxhash64("text") if text_key is None else text_key
    sized = materialize(docs.select("doc_id", "source", word_count().alias("size"), text_key.alias("text_key")), "sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    targets = source_targets(materialize(sources, "sources"), weights, share, cap)
    # A join needs a key that is never null.
    key = F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name"))
    lookup = materialize(targets.withColumn("_source", key).drop("source"), "targets")
    joined = lookup_join(sized.withColumn("_source", key), lookup, ["_source"], "n_docs", "doc_id", "inner")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = joined.select(
        "doc_id", "source", "size", "source_size", "target", "text_key", expected.cast(KIND).alias("expected")
    )
    order = [F.col("size"), F.col("doc_id").asc_nulls_last(), F.col("text_key")]
    return systematic_copies(joined, "expected", "source", order, seed).drop("expected")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix: each input row as often as it is taken, all columns kept.

    Rows are known by their id and a hash of all columns. Rows that share both are copies of each
    other, and one of them is repeated as often as all of them are taken.
    """
    key = row_key(docs)
    plan = plan_mix(docs, text_key=key, **options).groupBy("doc_id", "text_key").agg(
        F.sum("copies").alias("__mix_copies"), F.count("*").alias("__mix_rows")
    )
    plan = plan.filter("__mix_copies > 0")
    keyed = docs.withColumn("__mix_key", key)
    same = keyed["doc_id"].eqNullSafe(plan["doc_id"]) & (keyed["__mix_key"] == plan["text_key"])
    joined = keyed.join(plan, same).select(*[keyed[c] for c in docs.columns], "__mix_key", "__mix_copies", "__mix_rows")
    single = joined.filter("__mix_rows = 1")
    repeated = joined.filter("__mix_rows > 1").dropDuplicates(["doc_id", "__mix_key"])
    taken = single.unionByName(repeated)
    return taken.select(*docs.columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__mix_copies"))).alias("__mix_copy")).drop("__mix_copy")
