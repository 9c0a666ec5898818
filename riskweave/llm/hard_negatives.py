"""Hard negatives by exact inner products, several candidates to one multiplication.

Components are whole numbers. Those of several candidates, made non-negative by a bias, are
put into separated fields of one wide number; a product with an anchor's component then
multiplies all of them at once, and the sum over components holds all scores, each in its own
field, from which they are unpacked exactly (Kronecker substitution).

Anchors and candidates are dealt into a grid of cells, so a task holds one bounded slab of
anchors and one bounded shard of candidates, however many rows share a label or a vector.
Every cell keeps the best few rows of each anchor; the best of all cells are chosen after.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.session import materialize

#: Rows of one cell of the grid.
ANCHORS_A_CELL, CANDIDATES_A_CELL = 8192, 32768
#: Anchors whose scores against a whole shard are held at a time.
ANCHORS_A_BLOCK = 64
#: A double holds every whole number up to this many bits.
EXACT_BITS = 53
LONG = np.iinfo(np.int64)

PARTIAL = "_anchor bigint, _part int, _id bigint, _score bigint"


def fields(anchors: np.ndarray, candidates: np.ndarray) -> tuple[int, int, int]:
    """(fields a number, bits a field, bias) with which every product is exact.

    A score is at most the anchor's absolute sum times the largest component. With a bias,
    sums over the topmost field stay under the anchor's absolute sum times the largest
    biased component. No field at all means that doubles cannot hold even one score.
    """
    if not anchors.size or not candidates.size:
        return 1, 2, 0
    weight = max(int(np.abs(anchors).sum(axis=1).max()), 1)
    low, high = int(candidates.min()), int(candidates.max())
    bias = max(0, -low)
    top = max(high + bias, 1)
    width = (weight * max(-low, high, 1)).bit_length() + 1
    spare = EXACT_BITS - 1 - (weight * top).bit_length()
    count = min(spare // width + 1, 62 // width) if spare >= 0 else 0
    return max(count, 0), width, bias


def packed(candidates: np.ndarray, count: int, width: int, bias: int) -> np.ndarray:
    """One row for each ``count`` candidates: their biased components in separated fields.

    Field k of row r belongs to candidate k * rows + r; missing candidates are zeros.
    """
    rows = -(-len(candidates) // count)
    padded = np.zeros((rows * count, candidates.shape[1]), np.int64)
    padded[: len(candidates)] = candidates
    shifted = (padded.reshape(count, rows, -1) + bias) << (np.arange(count) * width)[:, None, None]
    return shifted.sum(axis=0)


def scorer(anchors: np.ndarray, candidates: np.ndarray) -> Callable[[slice], np.ndarray]:
    """A function from a slice of the anchors to their scores against all candidates.

    Anchors and candidates are matrices of whole numbers. Numbers too large for doubles go
    through Python's numbers, which have any width, one candidate a field.
    """
    small = _fits(anchors) and _fits(candidates)
    count, width, bias = fields(anchors, candidates) if small else (0, 0, 0)
    if not count:
        wide, own = candidates.astype(object), anchors.astype(object)
        return lambda part: np.array([[sum(map(int.__mul__, a, c)) for c in wide] for a in own[part]], object)
    numbers = packed(candidates, count, width, bias).astype(np.float64).T.copy()
    own = anchors.astype(np.float64)
    mask, half = (1 << width) - 1, 1 << (width - 1)
    ones = sum(1 << (k * width) for k in range(count))

    def scores(part: slice) -> np.ndarray:
        product = (own[part] @ numbers).astype(np.int64)
        # What the bias added goes, and every field is lifted by a half, so none borrows.
        product += ((half - bias * anchors[part].sum(axis=1)) * ones)[:, None]
        out = np.empty((len(product), count, numbers.shape[1]), np.int64)
        for k in range(count):
            out[:, k] = ((product >> (k * width)) & mask) - half
        return out.reshape(len(product), -1)[:, : len(candidates)]

    return scores


def _fits(matrix: np.ndarray) -> bool:
    """Whether absolute sums of a row cannot leave 62 bits."""
    if matrix.dtype == object:
        return False
    most = max(-int(matrix.min(initial=0)), int(matrix.max(initial=0)))
    return most * max(matrix.shape[1], 1) < 1 << 50


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of whole numbers; shorter vectors go on with zeros.

    Components are rounded down. A matrix with one beyond 2^50 holds Python's numbers.
    """
    vectors = vectors.combine_chunks()
    lengths = np.asarray(pc.list_value_length(vectors), np.int64)
    flat = np.floor(np.asarray(pc.list_flatten(vectors), np.float64))
    large = bool(len(flat)) and float(np.abs(flat).max()) >= 2.0**50
    out = np.zeros((len(vectors), width), object if large else np.int64)
    rows = np.repeat(np.arange(len(vectors)), lengths)
    columns = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, columns] = [int(x) for x in flat] if large else flat.astype(np.int64)
    return out


def _best(scores: np.ndarray, allowed: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores among ``allowed`` places; equal scores in order."""
    if len(allowed) > 4 * n and scores.dtype != object:
        own = scores[allowed]
        allowed = allowed[own >= np.partition(own, len(own) - n)[len(own) - n]]
    return allowed[np.argsort(-scores[allowed], kind="stable")[:n]]


def _cell(left: pa.Table, right: pa.Table, choose) -> pa.Table:
    """Scores of a slab of anchors against a shard of candidates, and what ``choose`` takes."""
    if not left.num_rows or not right.num_rows:
        return _partial([], [], [], [])
    right = right.sort_by("_id")
    both = left["_pattern"], right["_vector"]
    width = max(1, *(pc.max(pc.list_value_length(v)).as_py() for v in both))
    anchors, candidates = (_matrix(v, width) for v in both)
    score = scorer(anchors, candidates)
    ids = right["_id"].to_numpy()
    labels = right["_label"].to_numpy()
    rows = left.drop_columns(["_pattern"]).to_pylist()
    out: tuple[list, ...] = ([], [], [], [])
    for start in range(0, len(rows), ANCHORS_A_BLOCK):
        block = score(slice(start, start + ANCHORS_A_BLOCK))
        for row, scores in zip(rows[start : start + ANCHORS_A_BLOCK], block, strict=True):
            for part, places in choose(row, scores, ids, labels):
                out[0].extend([row["_anchor"]] * len(places))
                out[1].extend([part] * len(places))
                out[2].append(ids[places])
                out[3].append(scores[places])
    return _partial(*out)


def _partial(anchors: list, parts: list, ids: list, scores: list) -> pa.Table:
    """Rows of ``PARTIAL``; scores beyond a long become its limit."""
    held = [max(LONG.min, min(LONG.max, int(s))) for run in scores for s in run]
    return pa.table(
        {
            "_anchor": pa.array(anchors, pa.int64()),
            "_part": pa.array(parts, pa.int32()),
            "_id": pa.array(np.concatenate(ids) if ids else [], pa.int64()),
            "_score": pa.array(held, pa.int64()),
        }
    )


def _grid(anchors: DataFrame, candidates: DataFrame, slabs: int, shards: int, choose) -> DataFrame:
    """All cells of slabs of anchors and shards of candidates."""

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        return _cell(left, right, choose)

    def dealt(rows: DataFrame, own: str, parts: int, other: str, copies: int) -> DataFrame:
        copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
        return rows.withColumn(own, F.pmod(F.col("_row"), F.lit(parts)).cast("int")).withColumn(other, copy)

    left = dealt(anchors, "_slab", slabs, "_shard", shards)
    right = dealt(candidates, "_shard", shards, "_slab", slabs).select("_slab", "_shard", "_id", "_label", "_vector")
    return left.groupBy("_slab", "_shard").cogroup(right.groupBy("_slab", "_shard")).applyInArrow(cell, PARTIAL)


def _first(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` best rows of each anchor and part, numbered from 1."""
    order = Window.partitionBy("_anchor", "_part").orderBy(F.desc("_score"), "_id")
    return rows.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    label: Column | str = "label",
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 10,
    least_percent: int = 30,
    most_percent: int = 90,
    anchors_a_cell: int = ANCHORS_A_CELL,
    candidates_a_cell: int = CANDIDATES_A_CELL,
) -> DataFrame:
    """Hard negatives for every anchor and each of its nearest rows of the same label.

    Rows: anchor_id, positive_id, rank, negative_id, positive_score, negative_score. A score
    is the inner product of components ``floor(scale * x)``. An anchor's positives are its
    ``positives`` best rows of the same label with another id; for each, the ``negatives``
    best rows of another label whose score is between the two percentages of the positive's.
    Equal scores go by smaller id.

    A row without an id or a label, or whose vector is null or has a null or non-finite
    component, takes no part. Vectors of unequal length are compared as if the shorter went
    on with zeros; an empty one scores 0. Rows that repeat an id are rows of their own, also
    as anchors. Scores beyond 64 bits are ordered exactly inside a cell and returned as the
    limit of a long. An empty table gives no rows; other columns are not looked at.
    """
    spark = vectors.sparkSession
    label = F.col(label) if isinstance(label, str) else label
    scaled = F.transform(F.col(vector), lambda x: x.cast("double") * F.lit(float(scale)))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    rows = vectors.where(
        F.col(key).isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & F.forall(F.col(vector), finite)
    ).select(
        F.col(key).cast("bigint").alias("_id"),
        label.cast("bigint").alias("_label"),
        scaled.alias("_vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("_is_anchor"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = materialize(rows, "mined-vectors")
    chosen = rows.where("_is_anchor").select(
        F.col("_row").alias("_anchor"), F.col("_id").alias("_own"), F.col("_label").alias("_mine"),
        F.col("_vector").alias("_pattern"), F.col("_row").alias("_row"),
    )
    total, n_anchors = rows.select(F.count("*"), F.count_if("_is_anchor")).first()
    slabs = max(1, -(-n_anchors // anchors_a_cell))
    shards = max(1, -(-total // candidates_a_cell), min(spark.sparkContext.defaultParallelism, total // 512))

    def same_label(row, scores, ids, labels) -> Iterator[tuple[int, np.ndarray]]:
        yield 0, _best(scores, np.flatnonzero((labels == row["_mine"]) & (ids != row["_own"])), positives)

    def in_window(row, scores, ids, labels) -> Iterator[tuple[int, np.ndarray]]:
        other = labels != row["_mine"]
        for positive in row["_positives"]:
            low, high = -(-least_percent * positive["score"] // 100), most_percent * positive["score"] // 100
            if low <= high:
                inside = np.flatnonzero(other & (scores >= low) & (scores <= high))
                yield positive["part"], _best(scores, inside, negatives)

    near = _first(_grid(chosen, rows, slabs, shards, same_label), positives)
    found = materialize(near.select("_anchor", "_rank", "_id", "_score"), "mined-positives")
    by_anchor = found.groupBy("_anchor").agg(
        F.collect_list(F.struct(F.col("_rank").alias("part"), F.col("_score").alias("score"))).alias("_positives")
    )
    hard = _first(_grid(chosen.join(by_anchor, "_anchor"), rows, slabs, shards, in_window), negatives)
    named = found.select(
        "_anchor",
        F.col("_rank").alias("_part"),
        F.col("_id").alias("positive_id"),
        F.col("_score").alias("positive_score"),
    ).join(chosen.select("_anchor", F.col("_own").alias("anchor_id")), "_anchor")
    return hard.join(named, ["_anchor", "_part"]).select(
        "anchor_id",
        "positive_id",
        F.col("_rank").cast("int").alias("rank"),
        F.col("_id").alias("negative_id"),
        "positive_score",
        F.col("_score").alias("negative_score"),
    )


def op13(embeddings: DataFrame) -> DataFrame:
    """Negatives for anchors whose id is divisible by 100; ids divisible by 7 carry the next label."""
    key, label = F.col("vec_id"), F.col("label").cast("bigint")
    moved = F.when(key % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(embeddings, key % 100 == 0, label=moved)


OP13_SQL = """
with rows as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
flat as (select vec_id, label, unnest(q) as x, generate_subscripts(q, 1) as k from rows),
scores as (
    select a.vec_id as a_id, c.vec_id as c_id, a.label = c.label as same, sum(a.x * c.x)::bigint as score
    from flat a join flat c on a.k = c.k
    where a.vec_id % 100 = 0 and a.vec_id <> c.vec_id
    group by all
),
positives as (
    select a_id, c_id, score from scores where same
    qualify row_number() over (partition by a_id order by score desc, c_id) <= 5
)
select p.a_id as anchor_id, p.c_id as positive_id,
    (row_number() over (partition by p.a_id, p.c_id order by n.score desc, n.c_id))::int as rank,
    n.c_id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join scores n on n.a_id = p.a_id
where not n.same and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
qualify row_number() over (partition by p.a_id, p.c_id order by n.score desc, n.c_id) <= 10
"""
