"""Exact top-k inner products by pivot-table elimination.

Every vector gets a row of a written table: its distances to many pivots. They say where it stands
among the pivots: the origin counts as one, so the distances give the inner products with the
others, hence its coordinates in their span and the length of what stands out of it. Two vectors are
at least as far apart as these positions, |q - x|^2 >= |Pq - Px|^2 + (|q'| - |x'|)^2, and as every
pivot lies in the span this is no less than the triangle inequality's | d(q, p) - d(x, p) | for
any of them: it is the largest lower bound that the table gives. With the lengths of both it
bounds the inner product from above, q.x <= Pq.Px + |q'||x'|. Candidates are evaluated in the order
of that bound until none that is left can reach the k-th best product, so the result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.operators.materialize import materialize

SCALE = 1024
TOP = 10
PIVOTS = 56
# They are chosen from so many vectors, whose products with a query also tell what its k-th best is at least.
SAMPLE = 1024
# A pivot stands out of the span of the others by at least this share of its length.
LEAST_NEW = 0.05
# Queries of one pass over the table; more queries take more passes.
BLOCK_QUERIES = 4096
# Rows that a task compares with the queries at a time, and components in them.
CHUNK = 1 << 16
CHUNK_COMPONENTS = 1 << 22
# Queries whose bounds are formed together.
TOGETHER = 32
# Scaled components from here on do not fit a bigint.
LARGEST = 1 << 63
# Inner products below this are sure to fit a bigint; the others are formed as Python's integers.
SURE = float(1 << 62)
TABLE_SCHEMA = "vec_id bigint, components array<bigint>, distances array<double>"


def whole_components(vectors: DataFrame, scale: int = SCALE, refuse: bool = False) -> DataFrame:
    """(vec_id, embedding) to (vec_id, components): floor(scale * x) of each component.

    Vectors that are null or hold a null or non-finite component take no part, nor do rows without
    id. A finite component that does not fit a bigint when scaled is an error with `refuse`, as in
    the SQL; without, its vector takes no part.
    """
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda x: x * F.lit(float(scale)))
    given = F.col("embedding").cast("array<double>")
    finite = F.forall(given, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < math.inf), F.lit(False)))
    fits = F.forall("_scaled", lambda x: F.abs(x) < float(LARGEST))
    if refuse:
        error = F.concat(F.lit("a component does not fit a bigint: vec_id "), F.col("vec_id").cast("string"))
        fits = F.when(fits, True).otherwise(F.raise_error(error).cast("boolean"))
    valid = F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))
    return (
        vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", scaled.alias("_scaled"))
        .filter(F.when(valid, fits).otherwise(False))
        .select("vec_id", F.transform("_scaled", lambda x: F.floor(x).cast("bigint")).alias("components"))
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros to the same width."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), flat.dtype)
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, at] = flat
    return out


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    rows, pivots = rows.astype(np.float64), pivots.astype(np.float64)
    square = (rows**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None] - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(square, 0.0))


def _unit(width: int) -> float:
    """What rounding can be to a sum of squares or products, in proportion."""
    return 4 * (width + 8) * float(np.finfo(np.float64).eps)


def choose_pivots(rows: np.ndarray, pivots: int) -> np.ndarray:
    """Rows that span much: each next one is what stands farthest out of the span of those chosen."""
    left = rows.astype(np.float64)
    lengths = np.sqrt((left**2).sum(axis=1))
    chosen: list[int] = []
    while len(chosen) < min(pivots, rows.shape[1], len(rows)):
        out = np.sqrt((left**2).sum(axis=1))
        out[out < LEAST_NEW * np.maximum(lengths, 1.0)] = 0.0
        at = int(out.argmax())
        if out[at] == 0:
            break
        chosen.append(at)
        axis = left[at] / out[at]
        left = left - (left @ axis)[:, None] * axis
    return rows[chosen]


@dataclass
class Places:
    """Where vectors stand among the pivots: coordinates in their span, the length of the rest, and
    by how much rounding may have moved the coordinates. `lengths` are the vectors' own."""

    inside: np.ndarray
    rest: np.ndarray
    lengths: np.ndarray
    moved: np.ndarray


def places(rows: np.ndarray, distances: np.ndarray, pivots: np.ndarray) -> Places:
    """From distances to pivots: p.x = (|x|^2 + |p|^2 - d(x, p)^2) / 2, taken to orthogonal axes."""
    unit = _unit(rows.shape[1])
    square = (rows.astype(np.float64) ** 2).sum(axis=1)
    lengths = np.sqrt(square)
    if not len(pivots):
        return Places(np.zeros((len(rows), 0)), lengths * (1 + unit), lengths, np.zeros(len(rows)))
    of_pivots = (pivots.astype(np.float64) ** 2).sum(axis=1)
    inverse = np.linalg.inv(np.linalg.qr(pivots.astype(np.float64).T, mode="r"))
    inside = (square[:, None] + of_pivots - distances**2) / 2 @ inverse
    stretch = math.sqrt(len(pivots)) * float(np.linalg.norm(inverse, 2))
    moved = 4 * unit * (square + of_pivots.max()) * stretch + unit * lengths
    out = np.maximum(square - (inside**2).sum(axis=1), 0.0)
    rest = np.sqrt(out + 2 * moved * (lengths + moved) + unit * square)
    return Places(inside, rest, lengths, moved)


def _bounds(queries: Places, rows: Places) -> np.ndarray:
    """(queries, rows): what the inner products are at most, with room for all rounding."""
    bound = queries.inside @ rows.inside.T
    bound += queries.rest[:, None] * rows.rest
    bound += queries.moved[:, None] * (rows.lengths + 2 * rows.moved)
    bound += queries.lengths[:, None] * (rows.moved + _unit(2 * queries.inside.shape[1]) * rows.lengths)
    bound += 1.0
    return bound


def _part(found: Places, some: slice) -> Places:
    return Places(found.inside[some], found.rest[some], found.lengths[some], found.moved[some])


@dataclass
class Pivots:
    """The pivots, and the sampled rows that they were chosen from."""

    rows: np.ndarray
    sample_ids: np.ndarray
    sample: np.ndarray


def pivot_table(vectors: DataFrame, pivots: int = PIVOTS) -> tuple[DataFrame, Pivots]:
    """(vec_id, components) to the written table with distances, and the pivots.

    Pivots come from a bounded sample chosen by hash of the id.
    """
    written = materialize(vectors, "vectors")
    width = written.agg(F.max(F.size("components"))).first()[0] or 0
    sample = written.orderBy(F.xxhash64("vec_id"), "vec_id", "components").limit(SAMPLE).collect()
    rows = np.array([[*r.components, *[0] * (width - len(r.components))] for r in sample], np.int64).reshape(len(sample), width)
    table = choose_pivots(rows, pivots)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _distances(_matrix(batch.column(1), width), table)
            lists = pa.array(list(found), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["vec_id", "components", "distances"])

    ids = np.array([r.vec_id for r in sample], np.int64)
    return materialize(written.mapInArrow(measure, TABLE_SCHEMA), "pivot-table"), Pivots(table, ids, rows)


def _at_least(queries: np.ndarray, own: np.ndarray, known: Pivots, top: int) -> np.ndarray:
    """What each query's k-th best product is at least: the k-th best among the sampled rows."""
    floor = np.full(len(queries), -math.inf)
    unit = _unit(queries.shape[1])
    sample = known.sample.astype(np.float64)
    lengths = np.sqrt((sample**2).sum(axis=1))
    for q, query in enumerate(queries.astype(np.float64)):
        others = known.sample_ids != own[q]
        if others.sum() >= top:
            least = sample[others] @ query - unit * lengths[others] * math.sqrt(float(query @ query))
            floor[q] = np.partition(least, len(least) - top)[len(least) - top]
    return floor


def _products(rows: np.ndarray, query: np.ndarray, sure: bool) -> np.ndarray:
    """Exact inner products: as 64-bit integers if they are sure to fit, else as Python's."""
    return rows @ query if sure else rows.astype(object) @ query.astype(object)


def _best(ids: np.ndarray, scores: np.ndarray, top: int) -> np.ndarray:
    """Places of the `top` largest scores, ties to smaller ids."""
    if scores.dtype != object:
        return np.lexsort((ids, -scores))[:top]
    return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:top], np.int64)


def _longs(scores: np.ndarray) -> pa.Array:
    if any(not -(1 << 63) <= s < 1 << 63 for s in scores.tolist()):
        raise OverflowError("an inner product among the best does not fit a bigint")
    return pa.array(scores.astype(np.int64))


def best_of(
    queries: np.ndarray,
    own: np.ndarray,
    asked: Places,
    ids: np.ndarray,
    rows: np.ndarray,
    found: Places,
    top: int,
    floor: np.ndarray,
) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(query number, ids, scores, evaluated) of each query's best rows of one chunk.

    `asked` and `found` are the places of queries and rows. `floor` holds what the k-th best score
    of each query is at least so far, and is raised here. What lies below it cannot enter; what
    equals it may, by its id.
    """
    longest = float(found.lengths.max(initial=0.0))
    for q in range(len(queries)):
        if q % TOGETHER == 0:
            bounds = _bounds(_part(asked, slice(q, q + TOGETHER)), found)
        bound = bounds[q % TOGETHER]
        sure = longest * float(asked.lengths[q]) < SURE
        left = np.flatnonzero((bound >= floor[q]) & (ids != own[q]))
        if not len(left):
            continue
        order = left[np.argsort(-bound[left], kind="stable")]
        scores, seen, step = np.empty(0, np.int64 if sure else object), 0, 4 * top
        while seen < len(order) and bound[order[seen]] >= floor[q]:
            some = order[seen : seen + step]
            scores = np.concatenate((scores, _products(rows[some], queries[q], sure)))
            seen, step = seen + len(some), step * 2
            if len(scores) >= top:
                # As floats, scores keep their order or become equal.
                floor[q] = max(floor[q], np.partition(scores.astype(np.float64), len(scores) - top)[len(scores) - top])
        some = order[:seen]
        keep = scores.astype(np.float64) >= floor[q]
        some, scores = some[keep], scores[keep]
        first = _best(ids[some], scores, top)
        yield q, ids[some][first], scores[first], seen


def _chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, so many at a time."""
    waiting: list[pa.RecordBatch] = []
    for whole in batches:
        at = 0
        while at < whole.num_rows:
            some = whole.slice(at, rows - sum(b.num_rows for b in waiting))
            at += some.num_rows
            waiting.append(some)
            if sum(b.num_rows for b in waiting) == rows:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([b.column(i) for b in waiting]) for i in range(whole.num_columns)], schema=whole.schema)
                waiting = []
    if waiting:
        first = waiting[0]
        yield pa.RecordBatch.from_arrays([pa.concat_arrays([b.column(i) for b in waiting]) for i in range(first.num_columns)], schema=first.schema)


def top_products(vectors: DataFrame, is_query, top: int = TOP, pivots: int = PIVOTS) -> DataFrame:
    """(vec_id, components) to (query_id, rank, vec_id, score): for each row that the condition
    `is_query` picks, its `top` largest inner products with the other rows, ties to smaller ids.

    Vectors of different length are filled up with zeros. Repeated ids are rows of their own but
    none is a candidate of a query of the same id; repeated queries of equal id are asked once,
    with the least of their vectors. No vector is left out: elimination is by proven bounds only.
    A product among the best that does not fit a bigint is an error.

    A pass broadcasts at most BLOCK_QUERIES queries, and its tasks read their own part of the
    pivot table and give at most `top` rows per query and task.
    """
    table, known = pivot_table(vectors, pivots)
    chosen = known.rows
    width = chosen.shape[1]
    asked = table.filter(is_query).groupBy("vec_id").agg(F.min("components").alias("components"))
    asked = materialize(asked, "queries")
    passes = math.ceil(asked.count() / BLOCK_QUERIES)
    found = None
    for number in range(passes):
        block = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == number).collect()
        own = np.array([r.vec_id for r in block], np.int64)
        queries = np.array([[*r.components, *[0] * (width - len(r.components))] for r in block], np.int64).reshape(len(block), width)
        least = _at_least(queries, own, known, top)

        def run(batches, own=own, queries=queries, least=least):
            floor = least.copy()
            at = places(queries, _distances(queries, chosen), chosen)
            best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for batch in _chunks(batches, min(CHUNK, max(1, CHUNK_COMPONENTS // max(width, 1)))):
                rows = _matrix(batch.column(1), width)
                there = places(rows, _matrix(batch.column(2), len(chosen)), chosen)
                ids = batch.column(0).to_numpy()
                for q, some, scores, _ in best_of(queries, own, at, ids, rows, there, top, floor):
                    if q in best:
                        some, scores = np.append(best[q][0], some), np.append(best[q][1], scores)
                    first = _best(some, scores, top)
                    best[q] = some[first], scores[first]
                    if len(first) == top:
                        floor[q] = max(floor[q], float(best[q][1][-1]))
            for q, (some, scores) in best.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), own[q])), pa.array(some), _longs(scores)], ["query_id", "vec_id", "score"]
                )

        part = table.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint")
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = table.sparkSession.createDataFrame([], "query_id bigint, vec_id bigint, score bigint")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
