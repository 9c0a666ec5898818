"""Language identification by nearest centroid.

A text is a vector of hashed character n-grams (one to three, inside words and with word
bounds), weighted by TF-IDF and scaled to length one. Each language has several centroids,
found by spherical k-means over a bounded sample of its labelled texts; document
frequencies are counted over all labelled texts. A text gets the language of the centroid
with the largest cosine, and is marked as rejected if even that one is farther away than
nearly all texts it was learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from riskweave.llm.common import fresh, slices

UNKNOWN = "und"
#: Texts that are counted at once: their counts take a number per text and bucket.
MOST_TEXTS = 512
_PLANES = 0x110000


@dataclass(frozen=True)
class LanguageSettings:
    """Size of the model. The sample per language and the languages bound what is collected."""

    buckets: int = 8192
    sample_per_language: int = 1500
    centroids: int = 4
    rounds: int = 8
    most_languages: int = 500
    reject_quantile: float = 0.001


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: its lower-case code point if it is a letter, else 0."""
    out = np.zeros(_PLANES, np.uint32)
    for code in range(_PLANES):
        character = chr(code)
        if character.isalpha():
            lower = character.lower()
            out[code] = ord(lower) if len(lower) == 1 else code
    return out


def counts(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram counts per text and bucket, letters per text); null is an empty text."""
    own = [t or "" for t in texts.to_pylist()]
    joined = "\0".join(own).encode("utf-32-le", "surrogatepass")
    code = _letters()[np.frombuffer(joined, np.uint32)]
    ends = np.cumsum([len(t) + 1 for t in own])
    doc = np.repeat(np.arange(len(own)), np.diff(np.concatenate([[0], ends])))[: len(code)]
    n_letters = np.bincount(doc[code > 0], minlength=len(own))
    # One bound between two words: runs of other characters shrink to a single 0.
    solid = np.flatnonzero((code > 0) | np.concatenate([[False], code[:-1] > 0]))
    code, doc = code[solid].astype(np.uint64), doc[solid].astype(np.int64)
    out = np.zeros(len(own) * buckets, np.int64)
    gram = np.zeros(len(code), np.uint64)
    for k in range(3):
        inside = np.ones(len(code), bool)
        shifted = np.zeros(len(code), np.uint64)
        shifted[k:] = code[: len(code) - k]
        if k:
            inside[:k] = False
            inside[k:] = doc[k:] == doc[: len(doc) - k]
        gram = (gram + shifted + np.uint64(k + 1)) * np.uint64(0x9E3779B97F4A7C15)
        gram ^= gram >> np.uint64(29)
        keep = inside & (code > 0) if k == 0 else inside
        bucket = (gram[keep] >> np.uint64(11)) % np.uint64(buckets)
        out += np.bincount(doc[keep] * buckets + bucket.astype(np.int64), minlength=len(out))
    return out.reshape(len(own), buckets), n_letters


def _vectors(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length one; a text without n-grams is all zero."""
    weighted = np.log1p(tf).astype(np.float32) * idf
    length = np.linalg.norm(weighted, axis=1, keepdims=True)
    return weighted / np.maximum(length, 1e-12)


@dataclass(frozen=True)
class LanguageModel:
    """Centroids as rows, the language of each, and the least cosine of a trusted answer."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    least_cosine: np.ndarray

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        tf, letters = counts(texts, len(self.idf))
        if not self.languages:
            n = len(tf)
            return [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
        cosine = _vectors(tf, self.idf) @ self.centroids.T
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(len(best)), best], 0, 1).astype(float)
        none = letters == 0
        named = [UNKNOWN if e else self.languages[b] for b, e in zip(best, none, strict=True)]
        score[none] = 0.0
        return named, score, none | (score < self.least_cosine[best])


def _clusters(
    rows: np.ndarray, settings: LanguageSettings, seed: int
) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: centroids of length one, and the row's cosine with its own."""
    k = min(settings.centroids, len(rows))
    rng = np.random.default_rng(seed)
    centroids = rows[rng.choice(len(rows), k, replace=False)]
    for _ in range(settings.rounds):
        own = (rows @ centroids.T).argmax(axis=1)
        sums = np.stack([rows[own == j].sum(axis=0) for j in range(k)])
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(length > 0, sums / np.maximum(length, 1e-12), centroids)
    return centroids.astype(np.float32), rows @ centroids.T


def _frequencies(train: DataFrame, text: str, buckets: int) -> tuple[np.ndarray, int]:
    """In how many of the texts each bucket occurs, and how many texts there are."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(buckets, np.int64), 0
        for batch in batches:
            for part in slices(batch.column(0), 1 << 20, MOST_TEXTS):
                tf, _ = counts(part, buckets)
                seen += (tf > 0).sum(axis=0)
                n += len(tf)
        found = np.flatnonzero(seen)
        yield pa.record_batch(
            {
                "bucket": pa.array(np.append(found, -1), pa.int32()),
                "n": pa.array(np.append(seen[found], n), pa.int64()),
            }
        )

    rows = (
        train.select(F.col(text))
        .mapInArrow(partial, "bucket int, n bigint")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    found = {r["bucket"]: r["n"] for r in rows}
    total = found.pop(-1, 0)
    out = np.zeros(buckets, np.int64)
    out[list(found)] = list(found.values())
    return out, total


def learn(
    train: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    settings: LanguageSettings | None = None,
) -> LanguageModel:
    """A model from all rows of ``train`` that have a language and a text.

    Document frequencies cover all of them; centroids are fitted on at most
    ``sample_per_language`` texts of each language, chosen by a hash of the id. Without
    any such row the model has no language, and every answer is ``und``.
    """
    settings = settings or LanguageSettings()
    train = train.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(doc_id).cast("string").alias("_id"),
        F.col(lang).cast("string").alias("_lang"),
        F.col(text).alias("_text"),
    )
    seen, total = _frequencies(train, "_text", settings.buckets)
    idf = (np.log((1 + total) / (1 + seen)) + 1).astype(np.float32)
    # A language may have most of the rows: a hash share of each leaves about twice the
    # sample, and only those few are ranked.
    sizes = train.groupBy("_lang").agg(F.count("*").alias("_n"))
    if sizes.count() > settings.most_languages:
        raise ValueError(f"more than {settings.most_languages} languages")
    slots = 1 << 30
    place = F.pmod(F.xxhash64("_id"), F.lit(slots))
    ranked = Window.partitionBy("_lang").orderBy("_place", "_id")
    chosen = (
        train.select("_lang", "_id", place.alias("_place"))
        .join(F.broadcast(sizes), "_lang")
        .where(F.col("_place") / slots < 2 * settings.sample_per_language / F.col("_n"))
        .distinct()
        .withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") <= settings.sample_per_language)
        .select("_lang", "_id")
    )
    size = settings.sample_per_language

    def fit(key, group):
        import pandas as pd

        group = group.sort_values(["_id", "_text"]).head(size)
        parts = slices(pa.array(group["_text"]), 1 << 20, MOST_TEXTS)
        rows = np.concatenate([_vectors(counts(p, len(idf))[0], idf) for p in parts])
        rows = rows[np.linalg.norm(rows, axis=1) > 0]
        if not len(rows):
            return pd.DataFrame({"_lang": [], "centroid": [], "least": []})
        centroids, cosine = _clusters(rows, settings, 0)
        least = float(np.quantile(cosine.max(axis=1), settings.reject_quantile))
        return pd.DataFrame(
            {"_lang": key[0], "centroid": [c.tolist() for c in centroids], "least": least}
        )

    fitted = (
        train.join(F.broadcast(chosen), ["_lang", "_id"])
        .groupBy("_lang")
        .applyInPandas(fit, "_lang string, centroid array<float>, least double")
        .collect()
    )
    fitted.sort(key=lambda r: r["_lang"])
    return LanguageModel(
        idf,
        np.array([r["centroid"] for r in fitted], np.float32).reshape(-1, settings.buckets),
        [r["_lang"] for r in fitted],
        np.array([r["least"] for r in fitted]),
    )


def identify(
    spark: SparkSession, docs: DataFrame, model: LanguageModel, text: str = "text"
) -> DataFrame:
    """``docs`` with lang_pred, score (cosine, 0 to 1) and rejected.

    A null text or one without a letter is ``und`` with score 0, and rejected. Columns
    that already have these names are replaced.
    """
    sent = spark.sparkContext.broadcast(model)

    @arrow_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def predicted(batch: pa.Array) -> pa.Array:
        named, scores, rejected = [], [], []
        for part in slices(batch, 1 << 20, MOST_TEXTS):
            a, b, c = sent.value.predict(part)
            named += a
            scores += b.tolist()
            rejected += c.tolist()
        return pa.StructArray.from_arrays(
            [pa.array(named, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
            names=["lang_pred", "score", "rejected"],
        )

    own = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    (answer,) = fresh(docs, "predicted")
    made = docs.select(*own, predicted(F.col(text)).alias(answer))
    return made.select(*own, f"{answer}.*")


def held_out(doc_id: str = "doc_id") -> Column:
    """The fifth of the ids that nothing is learned from; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def op2(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, rejected."""
    docs = docs.select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = learn(docs.where(~F.col("held_out")))
    return identify(spark, docs.select("doc_id", "held_out", "text"), model).drop("text")
