"""Training, evaluating and applying the second-stage classifier."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.constants import (
    CHUNK_ROWS,
    DECISION_THRESHOLD,
    FEATURE_COLUMNS,
    MIN_TRAINING_ROWS,
    MODEL_BINS,
    MODEL_DEPTH,
    MODEL_SEED,
    MODEL_STEP,
    MODEL_TREES,
    TRAIN_FRACTION,
    RuleSettings,
)
from riskweave.functions import reason_count
from riskweave.operators.features import FEATURE_INPUT, build_features
from riskweave.operators.flags import FLAG_COLUMNS
from riskweave.operators.skew import CHUNK, range_chunks
from riskweave.operators.split import apply_split, split_boundaries
from riskweave.session import checkpoint_dir, materialize


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    metrics: DataFrame


def training_gate(labelled: DataFrame, min_rows: int = MIN_TRAINING_ROWS) -> DataFrame:
    """One row: row count, distinct labels, and whether training may start.

    Labels are grouped first, so the distinct count shuffles one row per label and task.
    """
    per_label = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return per_label.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("label").alias("n_labels")
    ).withColumn("ready", (F.col("n_rows") >= min_rows) & (F.col("n_labels") >= 2))


def rough_cuts(quantiles: Sequence[float]) -> list[float]:
    """Bounds of the bins between quantiles; a value that fills several has a bin of its own."""
    heavy = {a for a, b in zip(quantiles, quantiles[1:]) if a == b}
    inner = {*quantiles, *(math.nextafter(value, math.inf) for value in heavy)}
    return [-math.inf, *sorted(inner), math.inf]


def middle_cuts(spans: Sequence[tuple[float, float]]) -> list[float]:
    """The same bins, from their least and largest values, cut in the middle of the gaps."""
    inner = []
    for (_, most), (least, _) in zip(spans, spans[1:]):
        middle = (most + least) / 2
        # A bin begins with its bound, and the middle belongs to the values below.
        inner.append(math.nextafter(middle if middle < least else most, math.inf))
    return [-math.inf, *inner, math.inf]


def binning(features: DataFrame) -> Bucketizer | None:
    """Bins, of equal weight, for features with more values than the trees tell apart.

    All rows count. The other features keep every value; None if there is nothing to bin.
    """
    distinct = [F.approx_count_distinct(c).alias(c) for c in FEATURE_COLUMNS]
    values = features.agg(*distinct).first()
    wide = [c for c in FEATURE_COLUMNS if values[c] > MODEL_BINS]
    if not wide:
        return None
    ranks = [k / MODEL_BINS for k in range(1, MODEL_BINS)]
    found = features.approxQuantile(wide, ranks, 1 / (8 * MODEL_BINS))
    names = {"inputCols": wide, "outputCols": [f"{c}_bin" for c in wide]}
    rough = Bucketizer(splitsArray=[rough_cuts(quantiles) for quantiles in found], **names)
    placed, cuts = rough.transform(features), []
    for column, into in zip(wide, names["outputCols"], strict=True):
        value = F.col(column).cast("double")
        spans = placed.groupBy(into).agg(F.min(value), F.max(value)).dropna()
        # One row per bin.
        cuts.append(middle_cuts([tuple(r)[1:] for r in spans.orderBy(into).collect()]))
    return Bucketizer(splitsArray=cuts, **names)


def train(features: DataFrame, *, trees: int = MODEL_TREES, seed: int = MODEL_SEED) -> PipelineModel:
    """Gradient-boosted trees on the feature columns; the stages keep their list.

    Boosting passes over its rows hundreds of times, and rows that agree in label, in bins
    and in the features without bins are the same to it. They are counted first and go in
    as one row with their number as weight, so a pass costs what the rows differ in.

    Bins are ordered numbers to the trees, not the categories that their attributes make of
    them. Spark looks for thresholds in a sample of some ``maxBins ** 2`` rows; with as many
    as there are rows it looks at all. No feature has more values for that than its bins.
    """
    checkpoint_dir(features.sparkSession)
    bins = binning(features)
    named = {} if bins is None else dict(zip(bins.getInputCols(), bins.getOutputCols(), strict=True))
    columns = [named.get(c, c) for c in FEATURE_COLUMNS]
    placed = features if bins is None else bins.transform(features)
    plain = [F.col(c).alias(c, metadata={}) for c in columns]
    counted = placed.groupBy("label", *plain).agg(F.count(F.lit(1)).cast("double").alias("rows"))
    counted = materialize(counted, "training")
    assembler = VectorAssembler(inputCols=columns, outputCol="features")
    trees_stage = GBTClassifier(
        labelCol="label",
        featuresCol="features",
        weightCol="rows",
        maxIter=trees,
        stepSize=MODEL_STEP,
        maxDepth=MODEL_DEPTH,
        maxBins=max(MODEL_BINS, math.isqrt(counted.count()) + 1),
        seed=seed,
        checkpointInterval=10,
    )
    fitted = Pipeline(stages=[assembler, trees_stage]).fit(counted)
    return PipelineModel([*([] if bins is None else [bins]), *fitted.stages])


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Add ``ml_score`` (probability of an attack) and the decision ``predicted``."""
    scored = model.transform(features)
    probability = vector_to_array(F.col("probability"))[1]
    kept = [c for c in features.columns if c not in ("ml_score", "predicted")]
    return scored.select(
        *kept,
        probability.alias("ml_score"),
        (probability >= DECISION_THRESHOLD).cast("int").alias("predicted"),
    )


def score_classes(predictions: DataFrame) -> DataFrame:
    """Rows that share a score, counted: ``ml_score, attacks, others, hits, called``.

    Counted map-side first, so a score that many rows share is one row per task.
    """
    attack, called = F.col("label") == 1, F.col("predicted") == 1
    return predictions.groupBy("ml_score").agg(
        F.count_if(attack).alias("attacks"),
        F.count_if(~F.coalesce(attack, F.lit(False))).alias("others"),
        F.count_if(attack & called).alias("hits"),
        F.count_if(called).alias("called"),
    )


def held_out_metrics(predictions: DataFrame, *, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Metrics of held-out rows; 0 where precision or recall is undefined, NaN AUC for one class.

    ``predictions`` carries ``label``, ``ml_score`` and ``predicted`` and is scanned once. The
    area under the curve is the exact rank sum: the share of (attack, other) pairs in which
    the attack has the higher score, equal scores counting a half. Classes of equal scores
    are sorted in range chunks, and a chunk needs only the others counted below it, so
    nothing is sorted as a whole and no point of the curve is dropped.
    """
    classes = materialize(score_classes(predictions), "score-classes")
    spark, rows = classes.sparkSession, classes.count()
    below, auc = F.lit(0).cast("bigint"), float("nan")
    sums = ("attacks", "others", "hits", "called")
    totals = classes.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])
    one = totals.first()
    if one["attacks"] and one["others"]:
        chunks = range_chunks(classes, ["ml_score"], rows, chunk_rows)
        before = W.orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
        # One row per chunk, of which there are few.
        carried = chunks.groupBy(CHUNK).agg(F.sum("others").alias("n"))
        carried = carried.select(CHUNK, F.coalesce(F.sum("n").over(before), below).alias("before"))
        within = W.partitionBy(CHUNK).orderBy("ml_score").rowsBetween(W.unboundedPreceding, -1)
        placed = chunks.withColumn("lower", F.coalesce(F.sum("others").over(within), below))
        won = F.col("attacks") * (2 * (F.col("before") + F.col("lower")) + F.col("others"))
        # Doubled, so that it stays a whole number; a decimal, since pairs outgrow 64 bits.
        halves = placed.join(F.broadcast(carried), CHUNK).agg(F.sum(won.cast("decimal(38,0)")))
        auc = float(halves.first()[0] / (2 * one["attacks"] * one["others"]))
    zero = F.lit(0.0)
    return spark.createDataFrame([one.asDict()], totals.schema).select(
        (F.col("attacks") + F.col("others")).alias("test_size"),
        F.col("attacks").alias("test_attack_count"),
        F.coalesce(F.try_divide("hits", "called"), zero).alias("precision"),
        F.coalesce(F.try_divide("hits", "attacks"), zero).alias("recall"),
        F.lit(auc).alias("auc"),
    )


def bounded_sample(rows: DataFrame, n: int, most: int) -> DataFrame:
    """About ``most`` of ``n`` rows, chosen by a hash of the key; all if there are no more."""
    if n <= most:
        return rows
    slots = 1 << 30
    place = F.pmod(F.xxhash64("idempotency_key"), F.lit(slots))
    return rows.filter(place < int(slots * most / n))


def train_and_evaluate(
    txns: DataFrame,
    *,
    settings: RuleSettings | None = None,
    fraction: float = TRAIN_FRACTION,
    trees: int = MODEL_TREES,
    seed: int = MODEL_SEED,
    min_rows: int = MIN_TRAINING_ROWS,
    max_rows: int | None = None,
) -> Trained:
    """Features, chronological split, fit and held-out metrics.

    ``txns`` carries ``label`` and ``rule_flag_count``. Too few rows or a single label are
    an error before anything is trained. The rows are written once to the shared folder, as
    the gate, the split and the feature windows all read them, and so are the features. The
    trees are fitted on all training rows, or on about ``max_rows`` of them if that is given;
    metrics cover all held-out rows.
    """
    txns = materialize(txns.select(*FEATURE_INPUT, "label"), "labelled")
    gate = training_gate(txns, min_rows).first()
    if not gate["ready"]:
        raise ValueError(
            f"not enough to train on: {gate['n_rows']} rows, {gate['n_labels']} labels"
        )
    boundaries = split_boundaries(txns, fraction)
    frame = materialize(
        apply_split(build_features(txns, settings=settings), boundaries), "features"
    )
    in_train = frame.filter(F.col("split") == "train")
    size = in_train.count()
    fitted = in_train if max_rows is None else bounded_sample(in_train, size, max_rows)
    model = train(fitted, trees=trees, seed=seed)
    held_out = predict(model, frame.filter(F.col("split") == "test"))
    metrics = held_out_metrics(held_out).select(F.lit(size).cast("bigint").alias("train_size"), "*")
    return Trained(model, metrics)


def pending_for_scoring(flags: DataFrame) -> DataFrame:
    return flags.filter(F.col("ml_score").isNull())


def score_pending(
    flags: DataFrame,
    txns: DataFrame,
    model: PipelineModel,
    *,
    settings: RuleSettings | None = None,
) -> DataFrame:
    """The flag table with a score on every pending flag whose transaction is stored.

    Features look back over the whole history of an account and at no other account, so
    only accounts with an unscored flag are read, and of those only the rows from the
    first such flag on are given features. A flag is scored once.
    """
    waiting = pending_for_scoring(flags)
    first = F.min(F.unix_micros("occurred_at")).alias("since_us")
    since = waiting.groupBy("account_id").agg(first)
    built = build_features(
        txns.withColumn("rule_flag_count", F.lit(0)), settings=settings, since=since
    ).drop("rule_flag_count")
    # The flag count is a feature of the row alone: it joins the few rows at the end, and
    # the history is not shuffled by key.
    counts = waiting.select(
        "idempotency_key", reason_count(F.col("reasons")).alias("rule_flag_count")
    )
    unscored = built.join(counts, "idempotency_key")
    scores = predict(model, unscored).select("idempotency_key", F.col("ml_score").alias("found"))
    return flags.join(scores, "idempotency_key", "left").select(
        *[
            F.coalesce("ml_score", "found").alias(c) if c == "ml_score" else F.col(c)
            for c in FLAG_COLUMNS
        ]
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """A stored model; one that was fitted on other features, or in another order, is refused."""
    model = PipelineModel.load(path)
    bins = [s for s in model.stages if isinstance(s, Bucketizer)]
    raw = {o: i for s in bins for i, o in zip(s.getInputCols(), s.getOutputCols(), strict=True)}
    assemblers = [s for s in model.stages if isinstance(s, VectorAssembler)]
    stored = [[raw.get(c, c) for c in s.getInputCols()] for s in assemblers]
    if stored != [list(FEATURE_COLUMNS)]:
        raise ValueError(f"{path} was fitted on {stored}, not on {list(FEATURE_COLUMNS)}")
    return model
