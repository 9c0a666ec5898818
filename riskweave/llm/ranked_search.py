"""Ranked lexical search by pipelined term partitioning.

Terms belong to owners, the rarest to the first. Documents are dealt into shards, and an owner
holds, for each shard, the postings of its terms. Items travel in bundles: for every shard a
bundle carries sparse accumulators of documents through the stages of all owners, each a
cogroup that adds the owner's whole-number contributions. After a stage a document goes if it
cannot reach the shard's best any more, whatever the later owners add; nothing else does. The
last stage selects the best of each shard, and the best of all shards follow.

Only terms of items have postings. Their dictionary goes to the tasks; items beyond a fixed
size are searched in several passes, so it is bounded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskweave.llm.common import LOWER_ASCII, lists, lower_ascii, slices, utf8, words
from riskweave.session import materialize, scratch_path

#: Maximal runs of ASCII letters and digits and of everything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_SEPARATES = np.ones(256, bool)
_SEPARATES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

POSTINGS = "_place bigint, _id bigint, _n bigint, _terms array<int>, _tfs array<int>"
OWNED = (
    "_owner int, _shard int, _terms array<int>, _ends array<int>, _places array<int>, "
    "_gains array<int>, _ids array<bigint>"
)
CARRIED = "_bundle int, _shard int, _item int, _places array<int>, _scores array<bigint>"
SELECTED = "_item int, _id bigint, _score bigint"


@dataclass(frozen=True)
class SearchSettings:
    """``most_item_bytes`` of items are searched at a time; ``least_shards`` spread small tables."""

    best: int = 20
    owners: int = 4
    docs_a_shard: int = 16_384
    items_a_bundle: int = 256
    most_item_bytes: int = 16 << 20
    least_shards: int | None = None


class Dictionary:
    """Terms in order, found by hash and compared byte by byte."""

    def __init__(self, terms: list[str]):
        self.size = len(terms)
        encoded = [t.encode() for t in terms]
        data = np.frombuffer(b" ".join(encoded), np.uint8)
        hashed, start, end, _ = words(data, np.array([0, len(data)]), data == 32)
        self.order = np.argsort(hashed, kind="stable").astype(np.int64)
        self.hashed, self.data, self.start, self.length = hashed[self.order], data, start, end - start

    def find(self, data: np.ndarray, hashed: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of the term of each run of bytes, or -1."""
        found = np.full(len(hashed), -1, np.int64)
        if not self.size or not len(hashed):
            return found
        at = np.minimum(np.searchsorted(self.hashed, hashed), self.size - 1)
        near = np.flatnonzero(self.hashed[at] == hashed)
        term, length = self.order[at[near]], (end - start)[near]
        same = self.length[term] == length
        near, term, length = near[same], term[same], length[same]
        inner = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        equal = data[np.repeat(start[near], length) + inner] == self.data[np.repeat(self.start[term], length) + inner]
        differs = np.add.reduceat(~equal, np.cumsum(length) - length) if len(length) else np.empty(0, int)
        found[near[differs == 0]] = term[differs == 0]
        return found


def _counted(batches: Iterator[pa.RecordBatch], dictionary: Dictionary) -> Iterator[pa.RecordBatch]:
    """Length and counted dictionary terms of every document with a term."""
    for batch in batches:
        at = 0
        for run in slices(batch.column("_text")):
            data, bounds = utf8(run)
            data = LOWER_ASCII[data]
            hashed, start, end, doc = words(data, bounds, _SEPARATES[data])
            length = np.bincount(doc, minlength=len(run))
            term = dictionary.find(data, hashed, start, end)
            pairs, tfs = np.unique(
                doc[term >= 0] * max(dictionary.size, 1) + term[term >= 0], return_counts=True
            )
            owner = pairs // max(dictionary.size, 1)
            counts = np.bincount(owner, minlength=len(run))
            live = np.flatnonzero(length)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_place").slice(at, len(run)).take(pa.array(live)),
                    batch.column("_id").slice(at, len(run)).take(pa.array(live)),
                    pa.array(length[live], pa.int64()),
                    lists((pairs % max(dictionary.size, 1)).astype(np.int32), counts[live], pa.int32()),
                    lists(tfs.astype(np.int32), counts[live], pa.int32()),
                ],
                names=["_place", "_id", "_n", "_terms", "_tfs"],
            )
            at += len(run)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def gain(tf, m):
    """What one occurrence list adds for a unit of weight; whole numbers throughout."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


@dataclass(frozen=True)
class Plan:
    """Weights, owners and bounds of the terms, and the terms of the items, by number."""

    n_docs: int
    n_terms: int
    weights: np.ndarray
    owners: np.ndarray
    most: np.ndarray
    items: list[tuple[np.ndarray, np.ndarray]]
    settings: SearchSettings

    def rest(self, item: int, owner: int) -> int:
        """The most that owners after ``owner`` can add to one document."""
        terms, repeats = self.items[item]
        later = self.owners[terms] > owner
        return int((self.most[terms[later]] * repeats[later]).sum())


def _owned(shard: pa.Table, number: int, plan: Plan) -> pa.Table:
    """The postings of one shard by owner and term; documents are numbered by their id."""
    shard = shard.sort_by([("_id", "ascending"), ("_place", "ascending")])
    counts = np.asarray(pc.list_value_length(shard["_terms"].combine_chunks()), np.int64)
    term, tf = _flat(shard["_terms"]).astype(np.int64), _flat(shard["_tfs"]).astype(np.int64)
    place = np.repeat(np.arange(len(counts)), counts)
    m = 100 - 25 + (25 * shard["_n"].to_numpy().astype(np.int64) * plan.n_docs) // plan.n_terms
    gains = gain(tf, m[place])
    order = np.lexsort((place, term, plan.owners[term]))
    order = order[plan.weights[term[order]] > 0]
    term, place, gains = term[order], place[order], gains[order]
    owner = plan.owners[term]
    rows = []
    for own in range(plan.settings.owners):
        first, last = np.searchsorted(owner, [own, own + 1])
        held, starts = np.unique(term[first:last], return_index=True)
        ends = np.append(starts[1:], last - first)[: len(held)]
        ids = shard["_id"].to_pylist() if own + 1 == plan.settings.owners else []
        rows.append((own, number, held, ends, place[first:last], gains[first:last], ids))
    kinds = [pa.int32(), pa.int32(), *[pa.list_(pa.int32())] * 4, pa.list_(pa.int64())]
    names = ["_owner", "_shard", "_terms", "_ends", "_places", "_gains", "_ids"]
    return pa.table(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
    )


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten())


def _stage(key, carried: pa.Table, owned: pa.Table, plan: Plan, owner: int) -> pa.Table:
    """Adds what one owner knows of a shard to the accumulators of a bundle."""
    bundle, shard = (int(k.as_py()) for k in key)
    size = plan.settings.items_a_bundle
    terms, ends, places, gains = (_flat(owned[name]) for name in ("_terms", "_ends", "_places", "_gains"))
    starts = np.append(0, ends)[:-1]
    at = {int(t): slice(a, b) for t, a, b in zip(terms, starts, ends, strict=True)}
    before = {item: k for k, item in enumerate(carried["_item"].to_pylist())}
    held, scored = (carried[name].combine_chunks() for name in ("_places", "_scores"))
    top = max(int(places.max(initial=-1)), int(_flat(carried["_places"]).max(initial=-1)))
    total = np.zeros(top + 1, np.int64)
    out = []
    for item in range(bundle * size, min((bundle + 1) * size, len(plan.items))):
        total[:] = 0
        if item in before:
            total[held[before[item]].values.to_numpy()] = scored[before[item]].values.to_numpy()
        for term, repeats in zip(*plan.items[item], strict=True):
            if (run := at.get(int(term))) is not None:
                total[places[run]] += gains[run].astype(np.int64) * int(plan.weights[term] * repeats)
        live = np.flatnonzero(total)
        if len(live) > plan.settings.best:
            scores = total[live]
            nth = len(scores) - plan.settings.best
            least = np.partition(scores, nth)[nth]
            live = live[scores + plan.rest(item, owner) >= least]
        if len(live):
            out.append((item, live, total[live]))
    if owner + 1 < plan.settings.owners:
        return pa.table(
            {
                "_bundle": pa.array([bundle] * len(out), pa.int32()),
                "_shard": pa.array([shard] * len(out), pa.int32()),
                "_item": pa.array([item for item, _, _ in out], pa.int32()),
                "_places": pa.array([live.astype(np.int32) for _, live, _ in out], pa.list_(pa.int32())),
                "_scores": pa.array([scores for _, _, scores in out], pa.list_(pa.int64())),
            }
        )
    chosen = [
        (item, live[best], scores[best])
        for item, live, scores in out
        for best in [np.argsort(-scores, kind="stable")[: plan.settings.best]]
    ]
    flat = [np.concatenate([c[k] for c in chosen]) if chosen else np.empty(0, np.int64) for k in (1, 2)]
    named = np.repeat([c[0] for c in chosen], [len(c[1]) for c in chosen]) if chosen else []
    ids = owned["_ids"].combine_chunks().flatten()
    return pa.table(
        {
            "_item": pa.array(named, pa.int32()),
            "_id": ids.take(pa.array(flat[0], pa.int64())),
            "_score": pa.array(flat[1], pa.int64()),
        }
    )


def _stage_of(sent, owner: int):
    """The stage of one owner as Spark calls it."""

    def stage(key, carried: pa.Table, owned: pa.Table) -> pa.Table:
        return _stage(key, carried, owned, sent.value, owner)

    return stage


def _item_terms(items: DataFrame, text: str, key: str) -> DataFrame:
    """(_item, item_id, _term, _repeats): one row for each distinct term of an item."""
    found = F.regexp_extract_all(lower_ascii(F.coalesce(F.col(text), F.lit(""))), F.lit(TERM), F.lit(0))
    each = items.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(key).alias("item_id"),
        F.octet_length(text).alias("_bytes"),
        found.alias("_found"),
    )
    each = each.select("_row", "item_id", "_bytes", F.explode("_found").alias("_term"))
    return each.groupBy("_row", "item_id", "_bytes", "_term").agg(F.count("*").alias("_repeats"))


def _plan(postings: DataFrame, items: DataFrame, terms: list[str], settings: SearchSettings) -> Plan | None:
    """Statistics over all documents; bounded by the dictionary."""
    n_docs, n_terms = postings.agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0))).first()
    if not n_docs:
        return None
    each = postings.select(F.explode(F.arrays_zip("_terms", "_tfs")).alias("_p"))
    known = (
        each.groupBy(F.col("_p._terms").alias("term"))
        .agg(F.count("*").alias("df"), F.max("_p._tfs").alias("tf"))
        .collect()
    )
    weights, df, most = (np.zeros(len(terms), np.int64) for _ in range(3))
    for row in known:
        df[row.term] = row.df
        weights[row.term] = weight(n_docs, row.df)
        most[row.term] = weights[row.term] * gain(row.tf, 75)
    order = np.lexsort((np.arange(len(terms)), -weights))
    before = np.cumsum(df[order]) - df[order]
    owners = np.empty(len(terms), np.int64)
    owners[order] = np.minimum(before * settings.owners // max(int(df.sum()), 1), settings.owners - 1)
    number = {t: k for k, t in enumerate(terms)}
    grouped: dict[int, list] = {}
    for row in items.collect():
        grouped.setdefault(row["_item"], []).append((number[row["_term"]], row["_repeats"]))
    pairs = [np.array(sorted(grouped[k]), np.int64).T for k in range(len(grouped))]
    return Plan(n_docs, n_terms, weights, owners, most, [(p[0], p[1]) for p in pairs], settings)


def _search(docs: DataFrame, items: DataFrame, settings: SearchSettings) -> DataFrame | None:
    """(_item, _id, _score): the best of every shard for one pass of items."""
    spark: SparkSession = docs.sparkSession
    context = spark.sparkContext
    terms = sorted(r[0] for r in items.select("_term").distinct().collect())
    dictionary = context.broadcast(Dictionary(terms))
    counted = docs.mapInArrow(lambda batches: _counted(batches, dictionary.value), POSTINGS)
    postings = materialize(counted, "search-postings")
    plan = _plan(postings, items, terms, settings)
    if plan is None:
        return None
    sent = context.broadcast(plan)
    least = settings.least_shards or min(2 * context.defaultParallelism, plan.n_docs)
    shards = max(-(-plan.n_docs // settings.docs_a_shard), least)
    bundles = -(-len(plan.items) // settings.items_a_bundle)
    path = scratch_path(spark, "search-owners")
    (
        postings.withColumn("_shard", F.pmod("_place", F.lit(shards)).cast("int"))
        .groupBy("_shard")
        .applyInArrow(lambda key, rows: _owned(rows, int(key[0].as_py()), sent.value), OWNED)
        .write.partitionBy("_owner")
        .parquet(path)
    )
    index = spark.read.schema(OWNED).parquet(path)
    carried = spark.createDataFrame([], CARRIED)
    for owner in range(settings.owners):
        owned = index.where(F.col("_owner") == owner).withColumn(
            "_bundle", F.explode(F.sequence(F.lit(0), F.lit(bundles - 1)))
        )
        last = owner + 1 == settings.owners
        carried = (
            carried.groupBy("_bundle", "_shard")
            .cogroup(owned.groupBy("_bundle", "_shard"))
            .applyInArrow(_stage_of(sent, owner), SELECTED if last else CARRIED)
        )
    return carried


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    settings: SearchSettings | None = None,
) -> DataFrame:
    """item_id, rank, doc_id, score: the best documents of every item.

    Scores are whole numbers; a document needs a score above 0. Equal scores go by smaller
    id, a null id last. Null and empty texts have no terms: such a document is in no count,
    and such an item has no rows. Rows that repeat an id are documents or items of their
    own. Ids are whole numbers. Empty tables give no rows; other columns are not looked at.
    """
    settings = settings or SearchSettings()
    spark = docs.sparkSession
    wanted = materialize(_item_terms(items, item_text, item_id), "search-items")
    rows = wanted.select("_row", "item_id", "_bytes").distinct()
    total = rows.agg(F.coalesce(F.sum("_bytes"), F.lit(0))).first()[0]
    passes = max(1, -(-total // settings.most_item_bytes))
    own = docs.select(
        F.monotonically_increasing_id().alias("_place"),
        F.col(doc_id).cast("bigint").alias("_id"),
        F.col(text).alias("_text"),
    )
    results = []
    for number in range(passes):
        mine = wanted.where(F.pmod(F.xxhash64("_row"), F.lit(passes)) == number)
        # A pass is bounded, and so is the list of its items.
        listed = [r["_row"] for r in mine.select("_row").distinct().orderBy("_row").collect()]
        if not listed:
            continue
        numbers = spark.createDataFrame(list(enumerate(listed)), "_item int, _row bigint")
        mine = mine.join(F.broadcast(numbers), "_row")
        found = _search(own, mine, settings)
        if found is not None:
            named = mine.select("_item", "_row", "item_id").distinct()
            results.append(found.join(F.broadcast(named), "_item"))
    if not results:
        kind = wanted.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    order = Window.partitionBy("_row").orderBy(F.desc("_score"), F.asc_nulls_last("_id"))
    return (
        reduce(DataFrame.unionByName, results)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= settings.best)
        .select("item_id", "rank", F.col("_id").alias("doc_id"), F.col("_score").alias("score"))
    )


def op11(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return ranked_search(docs, items)


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP11_SQL = f"""
with words as (
    select doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '{TERM}')) as term from documents
),
tfs as (select doc_id, term, count(*) as tf from words group by all),
lengths as (select doc_id, sum(tf)::bigint as n from tfs group by doc_id),
totals as (select count(*) as n_docs, sum(n)::bigint as n_terms from lengths),
weights as (
    select term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)::double))::bigint as w
    from tfs, totals group by term
),
asked as (
    select item_id, unnest(regexp_extract_all({_LOWER.format("text")}, '{TERM}')) as term from benchmark
),
scores as (
    select item_id, doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::bigint as score
    from asked join tfs using (term) join weights using (term) join lengths using (doc_id), totals
    group by all
)
select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank,
    doc_id, score
from scores where score > 0
qualify row_number() over (partition by item_id order by score desc, doc_id) <= 20
"""
