"""Benchmark decontamination by latent semantic retrieval.

Passages are runs of words as TF-IDF vectors over hashed words. A randomised SVD, whose
products with the passage matrix are summed over tasks, gives a latent space; every
passage of every document is compared by cosine with the passages of all benchmark items.
What is near goes to a check of the words themselves: the longest common subsequence with
the item, and with the item's answer (its last sentence), so a paraphrase that keeps most
words in order is found and a text that is merely about the same is not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import WORK_BYTES, drop_table, slices, utf8, words
from riskweave.session import materialize


@dataclass(frozen=True)
class LatentSettings:
    """``max_fit_docs`` bounds the documents, and the items, that the SVD is fitted on.

    By default it is fitted on all of them; all are searched in any case.

    A leak needs ``lcs`` of the item's words in order, or ``lcs_with_answer`` if also
    ``answer`` of the answer's words are there, in a region as long as the item and a
    passage. A region longer by ``stretch`` of the item, for items with words put in
    between, counts by ``lcs`` alone.
    """

    buckets: int = 8192
    rank: int = 128
    oversample: int = 8
    max_fit_docs: int | None = None
    passage_words: int = 24
    least_cosine: float = 0.45
    lcs: float = 0.8
    lcs_with_answer: float = 0.6
    answer: float = 0.75
    stretch: float = 2.0
    answer_words: int = 8
    most_items: int = 200_000

    @property
    def stride(self) -> int:
        return self.passage_words // 2


#: Tasks that fit the SVD, or as many as the cluster has cores; each passes on one matrix.
FIT_TASKS = 16
#: Passages that a step of the fit works on, and texts that one counts the buckets of.
FIT_ROWS, FIT_TEXTS = 8192, 128
#: Rows added up one after the other; longer runs are cut and their sums added up.
RUN = 32
#: Sums under way together, and passages compared at once: what a core's cache holds.
RUNS_AT_ONCE, COMPARED = 512, 1024

_WORDLESS = np.ones(256, bool)
_WORDLESS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text index, words before each text) of the lower-cased words, without ASCII marks."""
    data, bounds = utf8(pc.utf8_lower(texts.cast(pa.large_string())))
    value, _, _, doc = words(data, bounds, _WORDLESS[data])
    return value, doc, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(texts)))])


def _buckets(value: np.ndarray, n: int) -> np.ndarray:
    return (value % np.uint64(n)).astype(np.int64)


def _runs(doc: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of runs of ``length`` words inside each text, and the text of each run."""
    place = np.arange(len(doc)) - first[:-1][doc]
    start = np.flatnonzero(place % length == 0)
    return start, doc[start]


def _encoded(texts: DataFrame, text: str, key: str, buckets: int) -> DataFrame:
    """``place``, by a hash of ``key``, and ``words``, the buckets in 16 bits each, written once.

    Frequencies and both passes of the fit read this, so words are hashed once.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, done = batch.column(0), 0
            for part in slices(batch.column(1), WORK_BYTES):
                value, _, first = word_hashes(part)
                data = _buckets(value, buckets).astype("<u2").tobytes()
                ends = pa.py_buffer((2 * first).astype(np.int64))
                own = pa.Array.from_buffers(pa.large_binary(), len(part), [None, ends, pa.py_buffer(data)])
                kept = place.slice(done, len(part))
                done += len(part)
                yield pa.record_batch([kept, own.cast(pa.binary())], names=["place", "words"])

    place = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 20)).cast("int")
    chosen = texts.select(place.alias("place"), F.col(text))
    return materialize(chosen.mapInArrow(encode, "place int, words binary"), "fit-words")


def _decoded(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all texts in a row, and the words before each text."""
    words = words.cast(pa.large_binary())
    _, offsets, data = words.buffers()
    bounds = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1] // 2
    value = np.frombuffer(data, "<u2") if data is not None else np.empty(0, "<u2")
    return value[bounds[0] : bounds[-1]], bounds - bounds[0]


def _few_tasks(rows: DataFrame) -> DataFrame:
    return rows.coalesce(max(FIT_TASKS, rows.sparkSession.sparkContext.defaultParallelism))


def _frequencies(encoded: DataFrame, buckets: int) -> tuple[np.ndarray, int]:
    """Documents that hold each bucket, over all documents, and their number."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(buckets, np.int64), 0
        for batch in batches:
            value, first = _decoded(batch.column(0))
            n += batch.num_rows
            for lo in range(0, batch.num_rows, FIT_TEXTS):
                own = first[lo : lo + FIT_TEXTS + 1]
                held = np.zeros((len(own) - 1, buckets), np.uint8)
                held[np.repeat(np.arange(len(own) - 1), np.diff(own)), value[own[0] : own[-1]]] = 1
                seen += held.sum(axis=0, dtype=np.int64)
        found = np.flatnonzero(seen)
        yield pa.record_batch(
            {
                "bucket": pa.array(np.append(found, -1), pa.int32()),
                "n": pa.array(np.append(seen[found], n), pa.int64()),
            }
        )

    summed = _few_tasks(encoded.select("words")).mapInArrow(partial, "bucket int, n bigint")
    found = {r[0]: r[1] for r in summed.groupBy("bucket").agg(F.sum("n")).collect()}
    total = found.pop(-1, 0)
    out = np.zeros(buckets, np.int64)
    out[list(found)] = list(found.values())
    return out, total


def run_sums(table: np.ndarray, index: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sums of ``table[index]`` over the runs that begin at ``start``, each up to the next."""
    index = index.astype(np.intp)
    while True:
        end = np.append(start, len(index))[1:]
        pieces = np.maximum(-(-(end - start) // RUN), 1)
        before = np.cumsum(pieces) - pieces
        cut = np.repeat(start, pieces) + RUN * (np.arange(pieces.sum()) - np.repeat(before, pieces))
        length = np.minimum(np.repeat(end, pieces) - cut, RUN)
        # The longest first: in each step those that have another row stand in front.
        order = np.argsort((RUN - length).astype(np.uint8), kind="stable")
        cut, length = cut[order], length[order]
        out = np.empty((len(cut), table.shape[1]), table.dtype)
        held, row = np.empty((2, RUNS_AT_ONCE, table.shape[1]), table.dtype)
        for lo in range(0, len(cut), RUNS_AT_ONCE):
            at, sizes = cut[lo : lo + RUNS_AT_ONCE], length[lo : lo + RUNS_AT_ONCE]
            sums = held[: len(at)]
            sums[:] = 0
            for k in range(int(sizes[0])):
                n = len(sizes) - int(np.searchsorted(sizes[::-1], k, side="right"))
                sums[:n] += np.take(table, index[at[:n] + k], axis=0, out=row[:n], mode="clip")
            out[order[lo : lo + RUNS_AT_ONCE]] = sums
        if len(out) == len(start):
            return out
        table, index, start = out, np.arange(len(out)), before


def _passages(words: pa.Array, length: int, idf: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks of the texts' passages: buckets, start and text row of each word, norms of TF-IDF rows."""
    value, first = _decoded(words)
    pieces = -(-np.diff(first) // length)
    before = np.cumsum(pieces) - pieces
    starts = np.repeat(first[:-1], pieces) + length * (np.arange(pieces.sum()) - np.repeat(before, pieces))
    square = idf * idf
    for lo in range(0, len(starts), FIT_ROWS):
        start = starts[lo : lo + FIT_ROWS]
        end = starts[lo + FIT_ROWS] if lo + FIT_ROWS < len(starts) else len(value)
        bucket, start = value[start[0] : end], start - start[0]
        sizes = np.diff(np.append(start, len(bucket)))
        row = np.repeat(np.arange(len(start)), sizes)
        norm = np.bincount(row, square[bucket], len(start))
        # A word that a passage holds n times counts n^2 times: once each, and twice a pair.
        for k in range(1, min(length, int(sizes.max()))):
            same = np.flatnonzero((bucket[k:] == bucket[:-k]) & (row[k:] == row[:-k]))
            norm += 2 * np.bincount(row[same], square[bucket[same]], len(start))
        yield bucket, start, row, np.maximum(np.sqrt(norm), 1e-12)


def _summed(encoded: DataFrame, product, rows: int, columns: int) -> np.ndarray:
    """The sum over all tasks of the matrices that ``product`` adds up from encoded texts."""
    names = [f"c{j}" for j in range(columns)]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((rows, columns))
        for batch in batches:
            product(batch.column(0), total)
        filled = np.flatnonzero(total.any(axis=1))
        yield pa.record_batch(
            [pa.array(filled, pa.int32()), *(pa.array(total[filled, j]) for j in range(columns))],
            names=["at", *names],
        )

    schema = "at int, " + ", ".join(f"{n} double" for n in names)
    summed = (
        _few_tasks(encoded.select("words"))
        .mapInArrow(partial, schema)
        .groupBy("at")
        .agg(*[F.sum(n).alias(n) for n in names])
        .toPandas()
    )
    out = np.zeros((rows, columns))
    out[summed["at"].to_numpy(int)] = summed[names].to_numpy()
    return out


@dataclass(frozen=True)
class LatentSpace:
    """Word weights times right singular vectors over singular values.

    The sum of its words' rows folds a passage in: all latent directions count alike, so
    the few that only tell languages apart do not drown the others.
    """

    projected: np.ndarray

    def embed(self, value: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Sums over the runs that begin at ``start``, each up to the next."""
        return run_sums(self.projected, _buckets(value, len(self.projected)), start)


def fit(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    settings: LatentSettings | None = None,
    items: DataFrame | None = None,
) -> LatentSpace:
    """The latent space of the passages of all documents and items, frequencies from all documents.

    The one column of ``items`` holds texts that are searched for; they join the fit, so that
    their words have a direction even where no document holds them. ``max_fit_docs`` leaves
    about so many documents, and as many items, to the SVD, chosen by a hash.

    Randomised: one product of the passage matrix and its transpose with a fixed random
    block finds the range; the Gram matrix inside that range gives the singular vectors.
    Products are sums of rows over the words that are there; the passage matrix is never
    made. Matrices that reach the driver have ``buckets`` by ``rank + oversample`` cells.
    """
    settings = settings or LatentSettings()
    size, width, length = settings.buckets, settings.rank + settings.oversample, settings.passage_words
    if size > 1 << 16:
        raise ValueError(f"{size} buckets; words are kept in 16 bits")
    made = [_encoded(docs, text, doc_id, size)]
    seen, total = _frequencies(made[0], size)
    idf = np.log((1 + total) / (1 + seen)) + 0.01
    fitted, counts = made[:], [total]
    if items is not None:
        made.append(_encoded(items, items.columns[0], items.columns[0], size))
        fitted, counts = made[:], [total, made[1].count()]
    if settings.max_fit_docs is not None:
        shares = [min(1.0, settings.max_fit_docs / max(n, 1)) for n in counts]
        fitted = [e.where(F.col("place") < int((1 << 20) * x)) for e, x in zip(made, shares, strict=True)]
    rows = reduce(DataFrame.unionByName, fitted)
    block = np.random.default_rng(7).standard_normal((size, width))

    def normal(matrix: np.ndarray):
        table = (idf[:, None] * matrix).astype(np.float32)

        def product(words: pa.Array, out: np.ndarray) -> None:
            for bucket, start, row, norm in _passages(words, length, idf):
                image = run_sums(table, bucket, start)
                image /= (norm * norm).astype(np.float32)[:, None]
                order = np.argsort(bucket, kind="stable")
                own, at = np.unique(bucket[order], return_index=True)
                out[own] += run_sums(image, row[order], at)

        return product

    def gram(matrix: np.ndarray):
        table = (idf[:, None] * matrix).astype(np.float32)

        def product(words: pa.Array, out: np.ndarray) -> None:
            for bucket, start, _, norm in _passages(words, length, idf):
                image = run_sums(table, bucket, start)
                image /= norm.astype(np.float32)[:, None]
                out += image.T @ image

        return product

    base, _ = np.linalg.qr(idf[:, None] * _summed(rows, normal(block), size, width))
    squares, vectors = np.linalg.eigh(_summed(rows, gram(base), width, width))
    for table in made:
        drop_table(table)
    singular = np.sqrt(np.maximum(squares[::-1][: settings.rank], 0))
    filled = singular > 1e-6 * max(singular.max(), 1e-300)
    latent = base @ vectors[:, ::-1][:, : settings.rank] / np.where(filled, singular, np.inf)
    return LatentSpace((idf[:, None] * latent).astype(np.float32))


def lcs_length(pattern: dict[int, int], length: int, text: list[int]) -> int:
    """Words of the longest common subsequence; ``pattern`` has a bit per place of each word."""
    row = full = (1 << length) - 1
    for word in text:
        hit = row & pattern.get(word, 0)
        row = ((row + hit) | (row - hit)) & full
    return length - row.bit_count()


@dataclass(frozen=True)
class Item:
    """A benchmark item: its words, the bit places of each, and where the answer begins."""

    item_id: int
    words: list[int]
    answer: int

    @staticmethod
    def masks(hashes: list[int]) -> dict[int, int]:
        out: dict[int, int] = {}
        for place, word in enumerate(hashes):
            out[word] = out.get(word, 0) | 1 << place
        return out


def _items(rows: list, settings: LatentSettings) -> list[Item]:
    out = []
    for item_id, text in rows:
        value, _, _ = word_hashes(pa.array([text]))
        sentence = re.split(r"(?<=[.!?])\s+", text.strip())[-1]
        own, _, _ = word_hashes(pa.array([sentence]))
        n = max(len(own), min(settings.answer_words, len(value)))
        if len(value):
            out.append(Item(item_id, value.tolist(), len(value) - n))
    return out


class Searcher:
    """Finds the leaks in a run of texts."""

    def __init__(self, space: LatentSpace, items: list[Item], settings: LatentSettings):
        self.space, self.items, self.settings = space, items, settings
        self.masks = [Item.masks(i.words) for i in items]
        self.distinct = [frozenset(i.words) for i in items]
        self.answers = [Item.masks(i.words[i.answer :]) for i in items]
        owner, offset, vectors = [], [], []
        for k, item in enumerate(items):
            value = np.array(item.words, np.uint64)
            last = max(len(value) - settings.passage_words, 0)
            for start in sorted({*range(0, last + 1, settings.stride), last}):
                part = value[start : start + settings.passage_words]
                vectors.append(space.embed(part, np.array([0]))[0])
                owner.append(k)
                offset.append(start)
        self.owner, self.offset = np.array(owner, int), np.array(offset, int)
        width = space.projected.shape[1]
        self.queries = self._unit(np.array(vectors, np.float32).reshape(len(owner), width))
        self.across = np.ascontiguousarray(self.queries.T)
        # Kept, as new pages of memory for each block cost a quarter of the comparison.
        self.cosine = np.empty((COMPARED, len(owner)), np.float32)

    @staticmethod
    def _unit(rows: np.ndarray) -> np.ndarray:
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)

    def most(self, k: int, region: list[int]) -> float:
        """At most this share of the item's words is in order: a missing one costs its place."""
        n, own = len(self.items[k].words), self.distinct[k]
        return (n - len(own) + len(own.intersection(region))) / n

    def check(self, k: int, region: list[int]) -> tuple[float, float]:
        """Share of the item's words, and of its answer's, found in order.

        Below ``lcs_with_answer`` the first is only an upper bound, and the second is 0.
        """
        item = self.items[k]
        n = len(item.words)
        most = self.most(k, region)
        if most < self.settings.lcs_with_answer:
            return most, 0.0
        whole = lcs_length(self.masks[k], n, region) / n
        if whole < self.settings.lcs_with_answer:
            return whole, 0.0
        m = n - item.answer
        return whole, lcs_length(self.answers[k], m, region) / m

    def is_leak(self, whole: float, answer: float) -> bool:
        s = self.settings
        return whole >= s.lcs or (whole >= s.lcs_with_answer and answer >= s.answer)

    def search(self, texts: pa.Array) -> list[tuple]:
        """(text index, item, cosine, lcs, answer, word) of every leak, the best place of each."""
        s = self.settings
        value, doc, first = word_hashes(texts)
        if not len(self.owner) or not len(value):
            return []
        start, owner = _runs(doc, first, s.stride)
        half = self.space.embed(value, start)
        passage = half.copy()
        follows = np.flatnonzero(owner[:-1] == owner[1:])
        passage[follows] += half[follows + 1]
        passage = self._unit(passage)
        best: dict[tuple[int, int], tuple] = {}
        for lo in range(0, len(passage), COMPARED):
            some = passage[lo : lo + COMPARED]
            cosine = np.matmul(some, self.across, out=self.cosine[: len(some)])
            near = np.flatnonzero(cosine.ravel() >= s.least_cosine)
            for at, q in zip(*np.divmod(near, len(self.queries)), strict=True):
                where, d, k = lo + at, int(owner[lo + at]), int(self.owner[q])
                n, before = len(self.items[k].words), int(self.offset[q])
                begin = max(start[where] - before - s.stride, first[d])
                end = min(start[where] - before + n + s.stride, first[d + 1])
                wide = max(int(begin - s.stretch * before), first[d])
                last = min(int(end + s.stretch * (n - before)), first[d + 1])
                region = value[wide:last].tolist()
                # What the wide region lacks is not in the other: most pairs end here.
                if self.most(k, region) < min(s.lcs, s.lcs_with_answer):
                    continue
                whole, answer = self.check(k, region[begin - wide : end - wide])
                leak = self.is_leak(whole, answer)
                if not leak:
                    begin = wide
                    whole, answer = self.check(k, region)
                    leak = whole >= s.lcs
                if leak:
                    found = (whole, float(cosine[at, q]), answer, int(begin - first[d]))
                    best[d, k] = max(best.get((d, k), found), found)
        return [
            (d, self.items[k].item_id, cosine, whole, answer, word)
            for (d, k), (whole, cosine, answer, word) in sorted(best.items())
        ]


LEAKS = "doc_id bigint, item_id bigint, cosine double, lcs double, answer double, word bigint"


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    settings: LatentSettings | None = None,
) -> DataFrame:
    """One row per document and benchmark item found in it; see ``LEAKS``.

    ``word`` is where in the document the compared region begins. Null and empty texts and
    items hold nothing. Rows that repeat an id are searched one by one and may give equal
    rows. The items are a stated query set, at most ``most_items``; more is an error.
    """
    settings = settings or LatentSettings()
    spark: SparkSession = docs.sparkSession
    asked = (
        benchmark.where(F.col(item_text).isNotNull())
        .select(F.col(item_id).cast("bigint"), F.col(item_text))
        .limit(settings.most_items + 1)
        .collect()
    )
    if len(asked) > settings.most_items:
        raise ValueError(f"more than {settings.most_items} benchmark items; split them")
    items = _items(sorted(asked, key=lambda r: (r[0] is None, r[0] or 0, r[1])), settings)
    searched = benchmark.where(F.col(item_text).isNotNull()).select(item_text)
    space = fit(docs, text, doc_id, settings, searched)
    sent = spark.sparkContext.broadcast((space, items, settings))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(*sent.value)
        for batch in batches:
            ids, done = batch.column(0), 0
            for part in slices(batch.column(1), 1 << 20):
                rows = searcher.search(part)
                columns = list(zip(*rows, strict=True)) if rows else [()] * 6
                own = ids.slice(done, len(part)).take(pa.array(columns[0], pa.int64()))
                done += len(part)
                kinds = (pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64())
                yield pa.record_batch(
                    [own, *(pa.array(c, t) for c, t in zip(columns[1:], kinds, strict=True))],
                    names=["doc_id", "item_id", "cosine", "lcs", "answer", "word"],
                )

    chosen = docs.select(F.col(doc_id).cast("bigint"), F.col(text))
    return chosen.mapInArrow(found, LEAKS)


def without_leaks(docs: DataFrame, leaks: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the ids in ``leaks``; a row without an id stays."""
    named = leaks.where("doc_id is not null").select(F.col("doc_id").alias("_leaked")).distinct()
    return docs.join(named, F.col(doc_id) == F.col("_leaked"), "left_anti")


def op8(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer, word) of every benchmark item in a document."""
    return find_leaks(docs.select("doc_id", "text"), benchmark)
