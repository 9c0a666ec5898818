"""Quality rules: a decision list learned by sequential covering.

Statistics of each whole text are counted over Arrow buffers. From all labelled ones a
list of rules is grown and pruned: a rule is a conjunction of thresholds, the list is an
ordered Spark expression that anyone can read, and what no rule matches is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType, StructField, StructType

from riskweave.llm.common import IS_SPACE, WORK_BYTES, drop_table, mix, slices, utf8, words
from riskweave.session import materialize

WINDOW = 5
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20

#: What is counted in a text, all long.
STATS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_marks",
    "n_digits",
    "n_distinct_words",
)
_IS_SYMBOL = np.isin(np.arange(256), [ord(c) for c in SYMBOLS])
_IS_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_IS_MARK = np.isin(np.arange(256), [ord(c) for c in "!?"])
_IS_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)


def _repeats(key: np.ndarray) -> np.ndarray:
    """True where a value of ``key`` occurs twice or more."""
    order = np.argsort(key)
    same = np.zeros(len(key) + 1, bool)
    np.equal(key[order][1:], key[order][:-1], out=same[1:-1])
    out = np.empty(len(key), bool)
    out[order] = same[1:] | same[:-1]
    return out


def _distinct(key: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Distinct values of ``key`` per document."""
    ordered = mix(key + doc.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))
    _, at = np.unique(ordered, return_index=True)
    return np.bincount(doc[at], minlength=n)


def count_stats(texts: pa.Array) -> dict[str, np.ndarray]:
    """The statistics of each text; a null is an empty text.

    Words and lines are compared by 64-bit hashes within one text.
    """
    data, bounds = utf8(texts)
    n = len(texts)

    def total(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(mask)])[bounds])

    space = IS_SPACE[data]
    value, _, _, doc = words(data, bounds, space)
    tagged = mix(value + doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    covered = np.zeros(len(value) + WINDOW + 1, np.int32)
    if len(value) >= WINDOW:
        last = len(value) - WINDOW + 1
        window = np.zeros(last, np.uint64)
        for k in range(WINDOW):
            window = mix(window + tagged[k : k + last])
        inside = np.flatnonzero(doc[:last] == doc[WINDOW - 1 :])
        found = inside[_repeats(window[inside])]
        np.add.at(covered, found, 1)
        np.add.at(covered, found + WINDOW, -1)
    repeated = np.cumsum(covered)[: len(value)] > 0

    line, start, end, line_doc = words(data, bounds, data == 10)
    seen = np.concatenate([[0], np.cumsum(~space)])
    filled = seen[end] > seen[start]
    line, line_doc = line[filled], line_doc[filled]
    n_filled = np.bincount(line_doc, minlength=n)
    return {
        "n_words": np.bincount(doc, minlength=n),
        "word_chars": total(~space & ((data & 0xC0) != 0x80)),
        "n_symbols": total(_IS_SYMBOL[data]),
        "n_dup_lines": n_filled - _distinct(line, line_doc, n),
        "n_repeat_words": np.bincount(doc[repeated], minlength=n),
        "n_lines": n_filled,
        "n_upper": total(_IS_UPPER[data]),
        "n_marks": total(_IS_MARK[data]),
        "n_digits": total(_IS_DIGIT[data]),
        "n_distinct_words": _distinct(value, doc, n),
    }


@arrow_udf(StructType([StructField(s, LongType()) for s in STATS]))
def _stats(texts: pa.Array) -> pa.Array:
    parts = [count_stats(part) for part in slices(texts, WORK_BYTES)]
    columns = [
        pa.array(np.concatenate([p[s] for p in parts]) if parts else [], pa.int64()) for s in STATS
    ]
    return pa.StructArray.from_arrays(columns, names=list(STATS))


# Marked so that a filter on a statistic stays above the call and does not repeat it.
_stats = _stats.asNondeterministic()


def with_stats(docs: DataFrame, text: str = "text", into: str = "_stats") -> DataFrame:
    """``docs`` with the struct ``into`` of all statistics of the whole text."""
    return docs.withColumn(into, _stats(F.col(text)))


def base_failed(stats: str = "_stats") -> Column:
    """Too few words, or too many of them in repeated five-word windows."""
    n, repeated = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n)


#: What rules may test: a count, or one count over another.
FEATURES: dict[str, tuple[str, str | None]] = {
    "n_words": ("n_words", None),
    "mean_word_chars": ("word_chars", "n_words"),
    "symbols_per_char": ("n_symbols", "word_chars"),
    "upper_per_char": ("n_upper", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
    "digits_per_char": ("n_digits", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_word_share": ("n_repeat_words", "n_words"),
    "distinct_word_share": ("n_distinct_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        value = table[self.feature]
        return value > self.threshold if self.above else value <= self.threshold

    def column(self, stats: str) -> Column:
        over, under = FEATURES[self.feature]
        value = F.col(f"{stats}.{over}").cast("double")
        if under:
            value = value / F.greatest(F.col(f"{stats}.{under}"), F.lit(1))
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class CoverSettings:
    """How rules are learned.

    All labelled rows count. ``bins`` bounds the values per feature that they are counted at
    and thus what reaches the driver; with no more rows than that, these are all values.
    """

    bins: int = 20_000
    cuts: int = 64
    max_conditions: int = 4
    max_rules: int = 24
    prune_share: float = 1 / 3
    least_precision: float = 0.9
    least_cover: int = 3


Rule = tuple[Condition, ...]


def feature_table(stats: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {
        name: stats[over].astype(float) / (np.maximum(stats[under], 1) if under else 1)
        for name, (over, under) in FEATURES.items()
    }


def _all_hold(rule: Rule, table: dict[str, np.ndarray]) -> np.ndarray:
    hit = np.ones(len(next(iter(table.values()))), bool)
    for condition in rule:
        hit &= condition.holds(table)
    return hit


@dataclass(frozen=True)
class Histogram:
    """Bad and good rows at the ascending ``values`` of a feature that have any."""

    values: np.ndarray
    bad: np.ndarray
    good: np.ndarray

    def quantiles(self, shares: np.ndarray) -> np.ndarray:
        """Linear between the two rows next to each share, like ``np.quantile``."""
        ends = np.cumsum(self.bad + self.good)
        place = (ends[-1] - 1) * shares
        at = np.floor(place)
        low = self.values[np.searchsorted(ends, at, side="right")]
        high = self.values[np.searchsorted(ends, np.minimum(at + 1, ends[-1] - 1), side="right")]
        t = place - at
        return np.where(t < 0.5, low + (high - low) * t, high - (high - low) * (1 - t))

    def upto(self, cut: float) -> tuple[int, int]:
        k = int(np.searchsorted(self.values, cut, side="right"))
        return int(self.bad[:k].sum()), int(self.good[:k].sum())


class LabelledRows:
    """Labelled rows as a table of STATS, ``_bad`` and ``_prune``; every count is a Spark job.

    Tasks pass on counts at the bounds of bins. The bounds are quantiles of all rows, so
    they are all values of a feature while there are no more rows than bins.
    """

    def __init__(self, rows: DataFrame, bins: int) -> None:
        self.rows = rows
        over = [F.col(over).cast("double") for over, _ in FEATURES.values()]
        under = [F.greatest(F.col(u), F.lit(1)) if u else F.lit(1) for _, u in FEATURES.values()]
        values = F.array(*[a / b for a, b in zip(over, under, strict=True)])
        # One in the middle of each bin, so that rounding skips no row, and the largest value.
        shares = ",".join(str(x) for x in [*((np.arange(bins) + 0.5) / bins), 1.0])
        shares = F.split(F.lit(shares), ",").cast("array<double>")
        grid = (
            rows.select(F.posexplode(values).alias("feature", "value"))
            .groupBy("feature")
            .agg(F.array_distinct(F.percentile_approx("value", shares, 2 * bins)).alias("grid"))
            .collect()
        )
        self.grid = [np.unique(r["grid"]) for r in sorted(grid)]
        self.sent = rows.sparkSession.sparkContext.broadcast(self.grid)

    def _counted(self, done: list[Rule], rule: Rule, prune: bool | None, features: list[str]) -> DataFrame:
        """(feature, bin, bad, good) of the rows that ``done`` leaves and ``rule`` hits.

        ``prune`` picks the rows that prune, or those that do not.
        """
        sent, names = self.sent, list(FEATURES)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = {f: np.zeros((2, len(sent.value[names.index(f)])), np.int64) for f in features}
            for batch in batches:
                column = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
                table, bad = feature_table(column), column["_bad"].astype(bool)
                hit = _all_hold(rule, table)
                if prune is not None:
                    hit &= column["_prune"].astype(bool) == prune
                for earlier in done:
                    hit &= ~_all_hold(earlier, table)
                for f, sums in total.items():
                    grid = sent.value[names.index(f)]
                    at = np.minimum(np.searchsorted(grid, table[f]), len(grid) - 1)
                    for k, mask in enumerate((hit & bad, hit & ~bad)):
                        sums[k] += np.bincount(at[mask], minlength=len(grid))
            for f, sums in total.items():
                at = np.flatnonzero(sums.any(axis=0))
                yield pa.record_batch(
                    {
                        "feature": pa.array(np.full(len(at), names.index(f)), pa.int32()),
                        "bin": pa.array(at, pa.int32()),
                        "bad": pa.array(sums[0][at]),
                        "good": pa.array(sums[1][at]),
                    }
                )

        return self.rows.mapInArrow(count, "feature int, bin int, bad bigint, good bigint")

    def histograms(
        self, done: list[Rule], rule: Rule, prune: bool | None, features: list[str] | None = None
    ) -> dict[str, Histogram]:
        features = features or list(FEATURES)
        made = (
            self._counted(done, rule, prune, features)
            .groupBy("feature", "bin")
            .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
            .toArrow()
            .sort_by([("feature", "ascending"), ("bin", "ascending")])
        )
        feature, at, bad, good = (made[c].to_numpy() for c in ("feature", "bin", "bad", "good"))
        out = {}
        for k, name in enumerate(FEATURES):
            own = feature == k
            if name in features:
                out[name] = Histogram(self.grid[k][at[own]], bad[own], good[own])
        return out

    def totals(self, done: list[Rule], rule: Rule, prune: bool | None) -> tuple[int, int]:
        """Bad and good rows."""
        made = self.histograms(done, rule, prune, ["n_words"])["n_words"]
        return int(made.bad.sum()), int(made.good.sum())


def _grow(rows: LabelledRows, done: list[Rule], settings: CoverSettings) -> Rule:
    """Adds the threshold with the largest information gain until none is wrong or helps."""
    rule, shares = (), np.linspace(0, 1, settings.cuts + 2)[1:-1]
    while len(rule) < settings.max_conditions:
        table = rows.histograms(done, rule, False)
        first = next(iter(table.values()))
        p, n = int(first.bad.sum()), int(first.good.sum())
        if not p or not n:
            break
        best, gain = None, 1e-9
        for feature, own in table.items():
            for cut in np.unique(own.quantiles(shares)):
                low = own.upto(cut)
                for above in (True, False):
                    p1, n1 = (p - low[0], n - low[1]) if above else low
                    if p1 < settings.least_cover:
                        continue
                    won = p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n)))
                    if won > gain:
                        best, gain = Condition(feature, above, float(cut)), won
        if best is None:
            break
        rule = (*rule, best)
    return rule


def _prune(rows: LabelledRows, done: list[Rule], rule: Rule) -> Rule:
    """The shortest start of ``rule`` that does best on rows it was not grown on."""

    def worth(part: Rule) -> float:
        p, n = rows.totals(done, part, True)
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda x: (worth(x), -len(x)))


def _centre(rows: LabelledRows, done: list[Rule], rule: Rule) -> Rule:
    """Each threshold moved to the middle of the gap it cuts, so that it has a margin."""
    out = list(rule)
    for k, condition in enumerate(rule):
        rest = (*out[:k], *out[k + 1 :])
        value = rows.histograms(done, rest, None, [condition.feature])[condition.feature].values
        low, high = value[value <= condition.threshold], value[value > condition.threshold]
        if len(low) and len(high):
            middle = float((low.max() + high.min()) / 2)
            out[k] = Condition(condition.feature, condition.above, middle)
    return tuple(out)


def cover(rows: LabelledRows, settings: CoverSettings | None = None) -> list[Rule]:
    """Rules for the rows where ``_bad``, best found first; none if a class is missing.

    A fixed third of the rows prunes what the others grew. Covered rows are taken away
    after each rule, and a rule that is wrong too often ends the list.
    """
    settings = settings or CoverSettings()
    rules: list[Rule] = []
    while len(rules) < settings.max_rules:
        grow, check = rows.totals(rules, (), False), rows.totals(rules, (), True)
        if grow[0] + check[0] < settings.least_cover or not grow[0]:
            break
        rule = _grow(rows, rules, settings)
        if not rule:
            break
        if sum(check):
            rule = _prune(rows, rules, rule)
        right, wrong = rows.totals(rules, rule, None)
        if right < settings.least_cover or right < settings.least_precision * (right + wrong):
            break
        rules.append(_centre(rows, rules, rule))
    return rules


def _with_pruning(rows: DataFrame, share: float) -> DataFrame:
    """``rows`` with ``_prune`` for a fixed share of them, by their place in hash order."""
    placed = materialize(
        rows.orderBy(F.xxhash64("_id"), "_id").withColumn("_place", F.monotonically_increasing_id()), "labelled"
    )
    part = F.shiftright("_place", 33)
    sizes = dict(placed.groupBy(part).count().collect())
    n = sum(sizes.values())
    chosen = np.zeros(n, bool)
    chosen[np.random.default_rng(0).permutation(n)[: int(n * share)]] = True
    starts = dict(zip(sorted(sizes), np.cumsum([0, *[sizes[k] for k in sorted(sizes)]]), strict=False))
    sent = rows.sparkSession.sparkContext.broadcast((starts, np.packbits(chosen)))

    @arrow_udf("boolean")
    def prunes(places: pa.Array) -> pa.Array:
        starts, bits = sent.value
        place = places.to_numpy(zero_copy_only=False)
        at = place & ((1 << 33) - 1)
        for k in np.unique(place >> 33):
            at[place >> 33 == k] += starts[k]
        return pa.array((bits[at >> 3] >> (7 - (at & 7))) & 1 == 1)

    made = materialize(placed.withColumn("_prune", prunes("_place")).drop("_id", "_place"), "learned-from")
    drop_table(placed)
    return made


def learn(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    settings: CoverSettings | None = None,
) -> list[Rule]:
    """A decision list from all documents with a label.

    Null ids and labels are left out, several labels of one id are averaged, and rows
    that the base rules reject are not learned from. The list is empty if nothing is
    labelled or all labels agree.
    """
    settings = settings or CoverSettings()
    known = (
        labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(doc_id).alias("_id"))
        .agg((F.avg(label) < 0.5).alias("_bad"))
    )
    # Counted before the join, so that no text is shuffled.
    counted = with_stats(docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")), "_text")
    rows = (
        counted.where(~base_failed())
        .select("_id", *[F.col(f"_stats.{s}").alias(s) for s in STATS])
        .join(known, "_id")
        .groupBy("_id", "_bad")
        .agg(*[F.min(s).alias(s) for s in STATS])
    )
    rows = _with_pruning(rows, settings.prune_share)
    rules = cover(LabelledRows(rows, settings.bins), settings) if rows.limit(1).count() else []
    drop_table(rows)
    return rules


def verdict(rules: list[Rule], stats: str = "_stats") -> Column:
    """True where no rule matches, as one ordered expression."""
    out = None
    for rule in rules:
        test = rule[0].column(stats)
        for condition in rule[1:]:
            test = test & condition.column(stats)
        out = F.when(test, False) if out is None else out.when(test, False)
    return F.lit(True) if out is None else out.otherwise(True)


def judge(
    docs: DataFrame, rules: list[Rule], text: str = "text"
) -> DataFrame:
    """``docs`` with ``_stats``, ``base_failed`` and ``kept``; a null text fails the base rules."""
    counted = with_stats(docs, text).withColumn("base_failed", base_failed())
    return counted.withColumn("kept", ~F.col("base_failed") & verdict(rules))


def op3(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: the base statistics, base_failed and kept."""
    made = judge(docs.select("doc_id", "text"), learn(docs, labels))
    return made.select(
        "doc_id", *[F.col(f"_stats.{s}").alias(s) for s in STATS[:5]], "base_failed", "kept"
    )
