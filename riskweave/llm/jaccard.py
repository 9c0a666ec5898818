"""Set similarity join on word n-grams, with skipping by the relations between sets.

* Equal sets are one class, so copies are never compared.
* Answers of highly similar sets: classes that agree in a min-hash key are compared with
  a few leaders only, drawn by hash. What links to one belongs to its cluster from then on,
  and pairs inside a cluster are not looked at again: the leader's answers hold for its
  followers. Every class meets some dozens of leaders, so of a large group whose members
  link with a part of each other only, few are left outside its cluster.
* Index lists: the rarest n-grams of a set (by counts over all texts, in hashed buckets) are
  indexed with their positions. Each list is summed up in blocks of near sizes and
  positions; pairs of blocks that cannot hold a similar pair, or hold one cluster only, are
  skipped as a whole, and entries are joined for the pairs of blocks that are left. Where
  they are many, a part of the classes is drawn first and meets the others, and what links
  joins a cluster before the next round, so a large group is not compared in pairs.
* A pair that survives is compared exactly, with sets made from the whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    LongType,
    StructField,
    StructType,
)

from riskweave.llm.common import (
    IS_SPACE,
    LOWER_ASCII,
    WORK_BYTES,
    drop_table,
    lists,
    mix,
    release,
    slices,
    utf8,
    words,
)
from riskweave.llm.graph import components
from riskweave.session import materialize

SHINGLE = 4
PERCENT = 85
#: N-grams are counted in buckets by hash, about so many a document and 2 ** MOST_BITS at most.
#: That bounds what a task holds and what is broadcast; n-grams that share a bucket only
#: move in the order, which changes no result.
BUCKETS_PER_DOC = 16
LEAST_BITS, MOST_BITS = 13, 23
#: N-grams that are counted at once, so that long texts do not make work arrays larger.
RUN_GRAMS = 1 << 20
#: The counts of so many buckets are summed up together.
COUNTED_TOGETHER = 1 << 13
#: A task counts no further in a bucket.
MOST_COUNTED = (1 << 16) - 1
#: Steps of the rank by doublings of the count.
RANK_STEPS = 8
#: Texts that are summed up at once; a sketch of each is made from 8 bytes a bit.
TEXTS_AT_ONCE = 1024
KEYS, KEY_PARTS = 16, 8
#: Classes that all others with a key are compared with.
LEADERS = 4
#: Bits of the parity sketch of a set. Each difference of two sets changes one bit at most.
SKETCH_BITS = 1024
#: Up to this many set identities (a few dozen bytes each) are broadcast to fetch texts.
BROADCAST_NODES = 200_000
POSITION_BLOCK = 4
#: Entries of index lists may meet so often per class in one round; see ``_list_links``.
MEETINGS = 4
LEAST_CLASSES = 1000
MORE_DRAWN = 8
#: Pairs are compared in passes whose sets take at most this share of all sets, or
#: PASS_BYTES if that is more.
PASS_SHARE = 0.25
PASS_BYTES = 64 << 20
#: The links of one component are dealt over this many parts when they get its name.
SALTS = 16


def _shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, documents): the 63-bit n-gram hashes of each text, with repeats.

    A text with fewer words than ``width`` has one n-gram of all its words; one without
    words has none.
    """
    data, bounds = utf8(texts)
    data = LOWER_ASCII[data]
    value, _, _, doc = words(data, bounds, IS_SPACE[data])
    n = len(value)
    per = np.bincount(doc, minlength=len(texts))
    short = (per > 0) & (per < width)
    first = np.concatenate([[0], np.cumsum(per)])[:-1]
    gram = np.zeros(max(n - width + 1, 0), np.uint64)
    for k in range(width):
        gram = mix(gram + value[k : k + len(gram)])
    whole = doc[: len(gram)] == doc[width - 1 :] if n >= width else np.zeros(0, bool)
    few = []
    for d in np.flatnonzero(short):
        h = np.full(1, per[d], np.uint64)
        for v in value[first[d] : first[d] + per[d]]:
            h = mix(h + v)
        few.append(h[0])
    grams = np.concatenate([gram[whole], np.array(few, np.uint64)]) >> np.uint64(1)
    return grams, np.concatenate([doc[: len(gram)][whole], np.flatnonzero(short)])


def _bucket(grams: np.ndarray, buckets: int) -> np.ndarray:
    return (grams & np.uint64(buckets - 1)).astype(np.int64)


def shingle_sets(
    texts: pa.Array, width: int, ranks: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, documents): the distinct ``_shingles`` of each text, in order.

    The order is by the rank of their bucket in ``ranks``, and by hash where that is equal.
    """
    grams, docs = _shingles(texts, width)

    def by_doc(order: np.ndarray) -> np.ndarray:
        small = docs.astype(np.uint16) if len(texts) < 1 << 16 else docs
        return order[np.argsort(small[order], kind="stable")]

    order = by_doc(np.argsort(grams))
    grams, docs = grams[order], docs[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (docs[1:] != docs[:-1])
    grams, docs = grams[new], docs[new]
    if ranks is not None:
        order = by_doc(np.argsort(ranks[_bucket(grams, len(ranks))], kind="stable"))
        grams, docs = grams[order], docs[order]
    return grams, docs


def _sum_by(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])[ends]
    return np.diff(total)


def _keys(grams: np.ndarray, docs: np.ndarray, n: np.ndarray) -> np.ndarray:
    """KEYS values per text; each joins the least hashes of two or three parts of the hash range.

    Similar sets agree in most of them, and sets that have a line in common only in few. The
    size class is part of a key; classes of odd keys are shifted by a half, so that sizes on
    either side of a bound share the others.
    """
    low = np.full((len(n), KEY_PARTS), np.iinfo(np.uint64).max, np.uint64)
    part = (grams >> np.uint64(32)) % np.uint64(KEY_PARTS)
    np.minimum.at(low, (docs, part.astype(np.int64)), grams)
    size = np.log(np.maximum(n, 1)) / np.log(100 / PERCENT)
    out = []
    for k in range(KEYS):
        key = mix(low[:, k % KEY_PARTS] + np.floor(size + k % 2 / 2).astype(np.uint64))
        for step in (1, 3)[: 1 + k // KEY_PARTS]:
            key = mix(key + low[:, (k + step) % KEY_PARTS])
        out.append(key + np.uint64(k))
    return np.stack(out, axis=1)


def _sketches(grams: np.ndarray, docs: np.ndarray, n_docs: int) -> np.ndarray:
    """Per text, SKETCH_BITS parities of the number of its n-grams that fall on each bit."""
    bit = ((grams >> np.uint64(17)) % np.uint64(SKETCH_BITS)).astype(np.int64)
    count = np.bincount(docs * SKETCH_BITS + bit, minlength=n_docs * SKETCH_BITS)
    odd = (count & 1).astype(np.uint8).reshape(n_docs, SKETCH_BITS)
    return np.packbits(odd, axis=1).view(np.int64)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


_SUMMARY = StructType(
    [
        StructField("n", LongType()),
        StructField("digest", BinaryType()),
        StructField("keys", ArrayType(LongType())),
        StructField("sketch", ArrayType(LongType())),
        StructField("prefix", ArrayType(LongType())),
    ]
)


def _summaries(spark: SparkSession, ranks: np.ndarray, width: int, percent: int):
    sent = spark.sparkContext.broadcast(ranks)

    @arrow_udf(_SUMMARY)
    def summaries(texts: pa.Array) -> pa.Array:
        done = []
        for part in slices(texts, WORK_BYTES, TEXTS_AT_ONCE):
            grams, docs = shingle_sets(part, width, sent.value)
            n = np.bincount(docs, minlength=len(part))
            ends = np.concatenate([[0], np.cumsum(n)])
            digest = np.stack([_sum_by(mix(grams), ends), _sum_by(mix(~grams), ends)], axis=1)
            digest = np.concatenate([digest, n[:, None].astype(np.uint64)], axis=1)
            length = np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)
            place = np.arange(len(grams)) - np.repeat(ends[:-1], n)
            prefix = grams[place < np.repeat(length, n)]
            keys = _keys(grams, docs, n)
            sketch = _sketches(grams, docs, len(n))
            done.append(
                pa.StructArray.from_arrays(
                    [
                        pa.array(n, pa.int64()),
                        pa.array([row.tobytes() for row in digest], pa.binary()),
                        lists(_signed(keys.ravel()), np.full(len(n), KEYS), pa.int64()),
                        lists(sketch.ravel(), np.full(len(n), sketch.shape[1]), pa.int64()),
                        lists(_signed(prefix), length, pa.int64()),
                    ],
                    fields=[
                        pa.field("n", pa.int64()),
                        pa.field("digest", pa.binary()),
                        pa.field("keys", pa.list_(pa.int64())),
                        pa.field("sketch", pa.list_(pa.int64())),
                        pa.field("prefix", pa.list_(pa.int64())),
                    ],
                )
            )
        return pa.concat_arrays(done)

    return summaries


def gram_ranks(docs: DataFrame, text: str, width: int) -> np.ndarray:
    """A rank per bucket of n-grams, by how often they occur in all texts.

    Each task counts its texts in one array. The arrays are dealt out in parts of
    COUNTED_TOGETHER buckets and summed up there; one byte a bucket is collected.
    """
    wanted = max(docs.count() * BUCKETS_PER_DOC - 1, 1)
    buckets = 1 << min(max(wanted.bit_length(), LEAST_BITS), MOST_BITS)
    together = min(buckets, COUNTED_TOGETHER)

    def batch_of(name: str, made: dict[int, np.ndarray]) -> pa.RecordBatch:
        packed = [pa.compress(own.tobytes(), "zstd", asbytes=True) for own in made.values()]
        return pa.record_batch(
            {"part": pa.array(list(made), pa.int32()), name: pa.array(packed, pa.binary())}
        )

    def unpacked(packed: bytes, kind: type) -> np.ndarray:
        size = together * np.dtype(kind).itemsize
        return np.frombuffer(pa.decompress(packed, size, "zstd", asbytes=True), kind)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.uint32)
        for batch in batches:
            for part in slices(batch.column(0), WORK_BYTES):
                grams = _shingles(part, width)[0]
                for k in range(0, len(grams), RUN_GRAMS):
                    np.add.at(counts, _bucket(grams[k : k + RUN_GRAMS], buckets), np.uint32(1))
        for k, own in enumerate(counts.reshape(-1, together)):
            if own.any():
                yield batch_of("counts", {k: np.minimum(own, MOST_COUNTED).astype(np.uint16)})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            for k, packed in zip(*batch.to_pydict().values(), strict=True):
                own = sums.setdefault(k, np.zeros(together, np.uint64))
                own += unpacked(packed, np.uint16)
        if sums:
            rank = {k: np.minimum(RANK_STEPS * np.log2(own + 1.0), 255) for k, own in sums.items()}
            yield batch_of("ranks", {k: own.astype(np.uint8) for k, own in rank.items()})

    rows = (
        docs.select(F.col(text))
        .mapInArrow(count, "part int, counts binary")
        .repartition("part")
        .mapInArrow(add, "part int, ranks binary")
        .toArrow()
    )
    ranks = np.zeros((buckets // together, together), np.uint8)
    for k, own in zip(rows["part"].to_pylist(), rows["ranks"].to_pylist(), strict=True):
        ranks[k] = unpacked(own, np.uint8)
    return ranks.ravel()


def _full_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, set) of the classes in ``nodes`` (node, rep, digest), from the text of ``rep``.

    A class without an id is found among the rows without one, by its digest.
    """
    own_set = _set_udf(width)
    few = nodes.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES
    asked = F.broadcast(nodes) if few else nodes
    made = docs.join(asked, docs["_doc"] == asked["rep"]).select(
        "node", "digest", own_set("_text").alias("_set")
    )
    unnamed = nodes.where("rep is null").select("node", "digest")
    loose = docs.where("_doc is null").select(own_set("_text").alias("_set"))
    found = loose.join(F.broadcast(unnamed) if few else unnamed, F.col("_set.digest") == F.col("digest"))
    # Rows may repeat an id; those of the class have its digest.
    return (
        made.where(F.col("_set.digest") == F.col("digest"))
        .unionByName(found.select("node", "digest", "_set"))
        .groupBy("node")
        .agg(F.first("_set.grams").alias("set"))
    )


_SET = StructType([StructField("digest", BinaryType()), StructField("grams", ArrayType(LongType()))])


def _set_udf(width: int):
    @arrow_udf(_SET)
    def made(texts: pa.Array) -> pa.Array:
        done = []
        for part in slices(texts, WORK_BYTES):
            grams, docs = shingle_sets(part, width)
            n = np.bincount(docs, minlength=len(part))
            ends = np.concatenate([[0], np.cumsum(n)])
            digest = np.stack([_sum_by(mix(grams), ends), _sum_by(mix(~grams), ends)], axis=1)
            digest = np.concatenate([digest, n[:, None].astype(np.uint64)], axis=1)
            done.append(
                pa.StructArray.from_arrays(
                    [
                        pa.array([row.tobytes() for row in digest], pa.binary()),
                        lists(_signed(grams), n, pa.int64()),
                    ],
                    names=["digest", "grams"],
                )
            )
        return pa.concat_arrays(done)

    # Else the filter on the digest would be pushed below the join, and with it the call.
    return made.asNondeterministic()


def _possible(classes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs that their sketches do not rule out.

    Bits that differ are no more than n-grams that differ, and similar sets of a and b
    n-grams differ in at most (100 - percent) / (100 + percent) of a + b.
    """
    own = classes.select("node", "n", "sketch")
    left = own.select(F.col("node").alias("a"), F.col("n").alias("_na"), F.col("sketch").alias("_sa"))
    right = own.select(F.col("node").alias("b"), F.col("n").alias("_nb"), F.col("sketch").alias("_sb"))
    bits = F.aggregate(
        F.zip_with("_sa", "_sb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x
    )
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where((100 + percent) * bits <= (100 - percent) * (F.col("_na") + F.col("_nb")))
        .select("a", "b", (F.col("_na") + F.col("_nb")).alias("_size"))
    )


def _linked(docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose sets are similar enough, compared exactly.

    A pair brings two whole sets together, so pairs are dealt by hash into passes; each is
    written down and its shuffles are let go before the next one.
    """
    pairs = materialize(_possible(classes, pairs, percent), "pairs")
    release(pairs.sparkSession)
    total = pairs.agg(F.sum("_size")).first()[0] or 0
    whole = classes.agg(F.sum("n")).first()[0] or 0
    passes = max(1, -(-8 * total // max(PASS_BYTES, int(8 * whole * PASS_SHARE))))
    asked = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    nodes = materialize(
        classes.select("node", "rep", "digest").join(asked.distinct(), "node", "left_semi"), "asked"
    )
    sets = materialize(_full_sets(docs, nodes, width), "sets")
    release(sets.sparkSession)
    dealt = F.pmod(F.xxhash64("a", "b"), F.lit(passes))
    parts = []
    for k in range(passes):
        parts.append(materialize(_compared(pairs.where(dealt == k), sets, percent), "links"))
        release(sets.sparkSession)
    for table in (pairs, nodes, sets):
        drop_table(table)
    return reduce(DataFrame.unionByName, parts)


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` that link; only sets of these pairs are shuffled."""

    def side(name: str) -> DataFrame:
        own = sets.select(F.col("node").alias(name), F.col("set").alias(f"_{name}"))
        return own.join(pairs.select(name).distinct(), name, "left_semi")

    both = F.size(F.array_intersect("_a", "_b"))
    return (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .select("a", "b", both.alias("_both"), (F.size("_a") + F.size("_b")).alias("_sum"))
        .where(100 * F.col("_both") >= percent * (F.col("_sum") - F.col("_both")))
        .select("a", "b")
    )


def _near(n1: str, n2: str, percent: int):
    return 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)


def _leader_pairs(classes: DataFrame, percent: int) -> DataFrame:
    """(a, b): each class with LEADERS classes that share a key with it, or all if fewer.

    The leaders of a key are the first by as many hash orders, so a key has few of them
    however many classes share it, and other keys have others.
    """
    keyed = classes.where("n > 0").select("node", "n", F.explode("keys").alias("key"))
    first = [F.min(F.struct(F.xxhash64("node", F.lit(k)).alias("h"), "node", "n")) for k in range(LEADERS)]
    led = (
        keyed.groupBy("key")
        .agg(
            F.array_distinct(F.transform(F.array(*first), lambda f: F.struct(f["node"], f["n"]))).alias("_l"),
            F.count("*").alias("_c"),
        )
        .where("_c > 1")
        .select("key", F.explode("_l").alias("_l"))
        .select("key", F.col("_l.node").alias("b"), F.col("_l.n").alias("_n"))
    )
    return (
        keyed.join(led, "key")
        .where((F.col("node") != F.col("b")) & _near("n", "_n", percent))
        .select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b"))
        .distinct()
    )


def _open_lists(classes: DataFrame, roots: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(pairs of blocks that may hold a similar pair of different clusters, their entries)."""
    size = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent))).cast("int")
    # What is dealt out by n-gram is narrow: size and position share a number, and the
    # cluster is left out where a class is its own.
    entries = (
        classes.where("n > 0")
        .join(roots, "node", "left")
        .select(
            "node",
            F.nullif("root", "node").alias("other"),
            "n",
            F.posexplode("prefix").alias("pos", "gram"),
        )
        .select("gram", "node", "other", (F.shiftleft(F.col("n"), 31) + F.col("pos")).alias("place"))
        .repartition("gram")
        .select(
            "gram",
            "node",
            F.coalesce("other", "node").alias("root"),
            F.shiftright("place", 31).alias("n"),
            F.col("place").bitwiseAND((1 << 31) - 1).alias("pos"),
        )
        .withColumn("size", size)
        .withColumn("block", F.floor(F.col("pos") / POSITION_BLOCK).cast("int"))
    )
    blocks = entries.groupBy("gram", "size", "block").agg(
        F.min("n").alias("n0"),
        F.max("n").alias("n1"),
        F.max(F.col("n") - F.col("pos")).alias("left"),
        F.min("root").alias("r0"),
        F.max("root").alias("r1"),
        F.count("*").alias("c"),
    )
    # Lists of one class end here: their block pairs only with itself, in one cluster.
    x, y = blocks.alias("x"), blocks.alias("y")
    may = (
        (F.col("x.size") <= F.col("y.size"))
        & (F.col("y.size") <= F.col("x.size") + 1)
        & ((F.col("x.size") < F.col("y.size")) | (F.col("x.block") <= F.col("y.block")))
        & ((F.col("x.r0") != F.col("x.r1")) | (F.col("y.r0") != F.col("y.r1")) | (F.col("x.r0") != F.col("y.r0")))
        & (100 * F.col("x.n1") >= percent * F.col("y.n0"))
        & ((100 + percent) * F.least("x.left", "y.left") >= percent * (F.col("x.n0") + F.col("y.n0")))
    )
    open_pairs = materialize(
        x.join(y, (F.col("x.gram") == F.col("y.gram")) & may).select(
            F.col("x.gram").alias("gram"),
            *[F.col(f"{s}.{c}").alias(f"{s}{c}") for s in ("x", "y") for c in ("size", "block", "c")],
        ),
        "open-blocks",
    )
    place = ("gram", "size", "block")
    sides = [open_pairs.select("gram", *[F.col(f"{s}{c}").alias(c) for c in place[1:]]) for s in ("x", "y")]
    asked = sides[0].unionByName(sides[1]).distinct()
    return open_pairs, materialize(
        entries.select(*place, "node", "n", "pos").join(asked, list(place), "left_semi"), "open-entries"
    )


def _list_pairs(
    open_pairs: DataFrame, entries: DataFrame, roots: DataFrame, percent: int, one_in: int
) -> DataFrame:
    """(a, b) of different clusters, one of them drawn, that index lists cannot rule out.

    One class in ``one_in`` is drawn by hash; with 1 the pairs are all.
    """
    own = entries.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    drawn = own.where(F.pmod(F.xxhash64("node", F.lit("drawn")), F.lit(one_in)) == 0)

    def met(e: DataFrame, f: DataFrame) -> DataFrame:
        left = open_pairs.alias("o").join(
            e.alias("e"),
            (F.col("o.gram") == F.col("e.gram"))
            & (F.col("o.xsize") == F.col("e.size"))
            & (F.col("o.xblock") == F.col("e.block")),
        ).select("o.*", *[F.col(f"e.{c}").alias(f"e{c}") for c in ("node", "root", "n", "pos")])
        rest = F.least(F.col("en") - F.col("epos"), F.col("f.n") - F.col("f.pos"))
        return (
            left.alias("l")
            .join(
                f.alias("f"),
                (F.col("l.gram") == F.col("f.gram"))
                & (F.col("l.ysize") == F.col("f.size"))
                & (F.col("l.yblock") == F.col("f.block"))
                & (F.col("eroot") != F.col("f.root"))
                & _near("en", "f.n", percent)
                & ((100 + percent) * rest >= percent * (F.col("en") + F.col("f.n"))),
            )
            .select(F.least("enode", "f.node").alias("a"), F.greatest("enode", "f.node").alias("b"))
        )

    if one_in == 1:
        return met(own, own).distinct()
    return met(drawn, own).unionByName(met(own, drawn)).distinct()


def _list_links(
    docs: DataFrame, classes: DataFrame, led: DataFrame, width: int, percent: int
) -> DataFrame:
    """Links between classes that lead on from ``led`` to all that similar sets reach.

    Where large groups would meet in full, one class in some is drawn first and meets all
    others: what links with it joins its cluster, so that the pairs inside are never made.
    Each round draws more, and the last one is over all pairs of different clusters.
    """
    roots = materialize(components(led), "clusters")
    open_pairs, entries = _open_lists(classes, roots, percent)
    rows = open_pairs.agg(F.sum(F.col("xc") * F.col("yc"))).first()[0] or 0
    most, one_in = MEETINGS * max(classes.count(), LEAST_CLASSES), 1
    while rows > most * one_in:
        one_in *= MORE_DRAWN
    while True:
        found = _linked(docs, classes, _list_pairs(open_pairs, entries, roots, percent, one_in), width, percent)
        # Clusters stand for all links before.
        links = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(found)
        if one_in == 1:
            drop_table(open_pairs)
            drop_table(entries)
            return links
        one_in //= MORE_DRAWN
        roots = materialize(components(links), "clusters")


def similar_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    width: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, n_shingles and component_id.

    Sets are the distinct ``width``-word n-grams of the whole text, A-Z lower-cased. Two
    texts link if their intersection is at least ``percent`` per cent of their union, and
    ``component_id`` is the smallest id that links lead to. A text without words links with
    nothing. A row without an id counts as its text, and has the component of its text, null
    if no text there has an id. Rows that repeat an id are judged by their own texts.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text"))
    made = _summaries(spark, gram_ranks(source, "_text", width), width, percent)
    base = materialize(source.select("_doc", made("_text").alias("_s")).select("_doc", "_s.*"), "base")
    members = materialize(base.select("_doc", "n", "digest"), "members")
    classes = materialize(
        base.groupBy("digest")
        .agg(
            F.min("_doc").alias("rep"),
            F.first("n").alias("n"),
            F.first("keys").alias("keys"),
            F.first("sketch").alias("sketch"),
            F.first("prefix").alias("prefix"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    drop_table(base)
    led = _linked(source, classes, _leader_pairs(classes, percent), width, percent)
    roots = components(_list_links(source, classes, led, width, percent))
    smallest = (
        classes.select("node", "rep")
        .join(roots, "node")
        .groupBy("root")
        .agg(F.min("rep").alias("component_id"))
    )
    # A component may hold a large share of all classes: its name goes to every part.
    smallest = smallest.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    named = (
        classes.where("n > 0")
        .select("node", "digest", "rep")
        .join(roots, "node", "left")
        .withColumn("_salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
        .join(smallest, ["root", "_salt"], "left")
        .select("digest", F.coalesce("component_id", "rep").alias("component_id"))
    )
    return (
        members.join(named, "digest", "left")
        .select(
            F.col("_doc").alias(doc_id),
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") == 0, F.col("_doc")).otherwise(F.col("component_id")).alias("component_id"),
        )
    )


def keep_smallest(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` without the ids that have a smaller id in their group.

    Rows that repeat an id go together: an id goes if one of its texts has a smaller
    partner. Texts without words and rows without an id stay.
    """
    groups = similar_groups(docs, doc_id, text, **settings)
    later = groups.where(F.col("component_id") < F.col(doc_id)).select(F.col(doc_id).alias("_later")).distinct()
    return docs.join(later, F.col(doc_id) == F.col("_later"), "left_anti")


def op5(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id."""
    return similar_groups(docs.select("doc_id", "text"))


OP5_SQL = r"""
with recursive split as (
  select doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') as w
  from documents),
sets as (
  select doc_id, list_sort(list_distinct(
           case when len(w) = 0 then []
                when len(w) < 4 then [array_to_string(w, ' ')]
                else list_transform(list_zip(w, w[2:], w[3:], w[4:])[1:len(w) - 3],
                                    lambda t: concat_ws(' ', t[1], t[2], t[3], t[4])) end)) as grams
  from split),
classes as (
  select row_number() over () as node, grams, len(grams) as n, min(doc_id) as rep
  from sets where len(grams) > 0 group by grams),
entries as (select node, n, unnest(grams) as gram from classes),
shared as (
  select a.node as a, b.node as b, count(*) as common, any_value(a.n) as n_a, any_value(b.n) as n_b
  from entries a join entries b on a.gram = b.gram and a.node < b.node
   and 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  group by a.node, b.node),
links as (select a, b from shared where 100 * common >= 85 * (n_a + n_b - common)),
edges as (select a, b from links union all select b, a from links),
reach(node, seen) as (
  select node, node from classes
  union
  select r.node, e.b from reach r join edges e on r.seen = e.a),
named as (
  select r.node, min(c.rep) as component_id
  from reach r join classes c on r.seen = c.node group by r.node)
select s.doc_id, cast(len(s.grams) as bigint) as n_shingles,
       case when len(s.grams) = 0 then s.doc_id else m.component_id end as component_id
from sets s left join classes c on s.grams = c.grams left join named m on c.node = m.node
"""
