"""The registered queries: one per operator, each over whole tables."""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.constants import DECISION_THRESHOLD, HIGH_RISK_CATEGORY, RuleSettings
from riskweave.functions import (
    amount_dollars,
    dollars_text,
    micros,
    parse_rfc3339,
    reason_count,
    reason_list,
    reasons_display,
    rfc3339_text,
)
from riskweave.functions.times import weekday
from riskweave.operators.dedupe import (
    batch_tally,
    dedupe_against_store,
    dedupe_feed,
)
from riskweave.operators.evaluate import evaluate, flag_totals, label_totals, report
from riskweave.operators.features import FEATURE_INPUT, build_features, with_label
from riskweave.operators.flags import (
    flag_by_key,
    flags_by_rule,
    ml_score_percent,
    new_flags,
    review,
    review_queue,
    risk_band,
    score_text,
    status_counts,
    upsert_flags,
    with_rule_flag_count,
)
from riskweave.operators.history import with_history
from riskweave.operators.model import (
    held_out_metrics,
    load_model,
    pending_for_scoring,
    save_model,
    score_pending,
    train,
    train_and_evaluate,
    training_gate,
)
from riskweave.operators.normalize import feed_counts, normalize_feed, union_feeds
from riskweave.operators.rules import geo_impossible, mcc_drift, score, velocity, with_distance
from riskweave.operators.split import apply_split, chronological_split
from riskweave.operators.summary import Summary, summarize
from riskweave.operators.validate import (
    add_missing_columns,
    dead_letters,
    flag_violations,
    outcome_tally,
    rejected,
    require_columns,
    retries,
    route_failures,
    status_filter,
    validate,
)
from riskweave.plans import inputs
from riskweave.plans.batch import feeds_to_transactions
from riskweave.schemas import RULE_INPUT, TXN
from riskweave.session import (
    materialize,
    scratch_path,
    state_partitions,
    use_rocksdb_state,
    use_utc,
)
from riskweave.sources.envelopes import parse_envelope, to_envelope, unparseable
from riskweave.sources.feeds import (
    FEEDS,
    delivery_gaps,
    explode_pages,
    read_feed,
    unreadable_pages,
)
from riskweave.sources.harness import (
    event_transactions,
    instant,
    order_transactions,
    table,
)
from riskweave.sources import page_chain as chain
from riskweave.sources.tables import (
    compact_transactions,
    count_transactions,
    insert_transactions,
    read_flag,
    read_batches,
    read_dated_transactions,
    read_transactions,
    replace_flags,
    verify_transactions,
    write_dated_transactions,
    write_transactions,
)
from riskweave.streaming.changes import change_stream, current_numbers, read_decisions
from riskweave.streaming.days import current_boundaries, day_stream
from riskweave.streaming.ingest import (
    dedupe_stream,
    drop_recent_duplicates,
    ingest_batch,
    ingest_stream,
    read_message_files,
)
from riskweave.streaming.isolate import isolated, read_poison
from riskweave.streaming.keys import load_history, remember, store_new
from riskweave.streaming.retry import read_failures, retry_stream
from riskweave.streaming.score import (
    dashboard_snapshot,
    read_flag_feed,
    read_transaction_files,
    score_pending_stream,
    score_stream,
)
from riskweave.streaming.stateful import rules_stateful
from riskweave.streaming.store import TALLY, Store, current_flags, read_scores, record_decisions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# Folder buckets of the tables that queries write.
BUCKETS = 4


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(use_utc(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _as_of() -> F.Column:
    return instant(inputs.AS_OF)


def _flat(txns: DataFrame, *more: str) -> DataFrame:
    return txns.select(
        "idempotency_key",
        "bank",
        "native_id",
        "account_id",
        "amount_cents",
        "currency",
        "merchant_name",
        "merchant_category",
        "city",
        micros(F.col("occurred_at")).alias("occurred_us"),
        *more,
    )


def _flags_flat(flags: DataFrame) -> DataFrame:
    return flags.select(
        "idempotency_key",
        "account_id",
        "amount_cents",
        "merchant_category",
        "reasons",
        micros(F.col("occurred_at")).alias("occurred_us"),
        "status",
        "ml_score",
        micros(F.col("created_at")).alias("created_us"),
        micros(F.col("updated_at")).alias("updated_us"),
    )


# --- sources, parsing, sinks --------------------------------------------------


@query
def read_feed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each feed written as newline-delimited JSON and read back with its schema."""
    records = inputs.native_records(spark, sf_dir)
    natives = {}
    for bank, feed in FEEDS.items():
        path = scratch_path(spark, f"feed-{bank}")
        records.filter(F.col("bank") == bank).select("body").write.text(path)
        natives[bank] = read_feed(spark, path, feed)
    return _flat(union_feeds(natives, as_of=_as_of()), "error")


@query
def explode_landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping pages to records, the first serving kept."""
    feed = FEEDS["bank-a"]
    records = explode_pages(inputs.landed_pages(spark, sf_dir), feed)
    return _flat(dedupe_feed(normalize_feed(records, feed, as_of=_as_of())))


@query
def pages_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page once whole and once cut off before its end."""
    pages = inputs.landed_pages(spark, sf_dir)
    cut = pages.withColumn("body", F.substring("body", F.lit(1), F.length("body") - 10))
    found = unreadable_pages(pages.unionByName(cut), FEEDS["bank-a"])
    return found.select("message_id", "retry_count", "reason")


@query
def page_delivery_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page cut off, one lost, and the page that the last one names never served."""
    pages = inputs.landed_pages(spark, sf_dir)
    cut = F.substring("body", F.lit(1), F.length("body") - 10)
    landed = pages.withColumn("body", F.when(F.col("page_no") == 2, cut).otherwise(F.col("body")))
    return delivery_gaps(landed.filter(F.col("page_no") != 5), FEEDS["bank-a"])


@query
def page_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six deliveries of all pages, five of them broken in one way each."""
    return chain.page_chain(inputs.damaged_deliveries(spark, sf_dir), FEEDS["bank-a"])


@query
def explode_chained_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping pages in the order of their cursors to records, the first serving kept."""
    feed = FEEDS["bank-a"]
    pages = inputs.cursor_pages(spark, sf_dir).withColumn("delivery", F.lit("whole"))
    records = explode_pages(chain.numbered_pages(pages, feed), feed)
    return _flat(dedupe_feed(normalize_feed(records, feed, as_of=_as_of())))


@query
def page_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as served, overlap included."""
    records = explode_pages(inputs.landed_pages(spark, sf_dir), FEEDS["bank-a"])
    return records.groupBy("page_no").agg(
        F.count(F.lit(1)).alias("n"), F.max("pos").cast("bigint").alias("last_pos")
    )


@query
def parse_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_envelope(inputs.damaged_messages(spark, sf_dir), _as_of())
    good = F.col("error").isNull()
    return parsed.select(
        "message_id",
        "error",
        F.when(good, F.col("idempotency_key")).alias("idempotency_key"),
        F.when(good, F.col("amount_cents")).alias("amount_cents"),
        F.when(good, F.col("city")).alias("city"),
        F.when(good, micros(F.col("occurred_at"))).alias("occurred_us"),
    )


@query
def unparseable_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unparseable(parse_envelope(inputs.damaged_messages(spark, sf_dir), _as_of())).select(
        "message_id", "retry_count", "reason", F.length("body").alias("body_length")
    )


@query
def to_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_envelope(event_transactions(spark, sf_dir))


@query
def stored_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table written by account bucket and read back, two columns pruned away."""
    path = scratch_path(spark, "transactions")
    write_transactions(event_transactions(spark, sf_dir), path, BUCKETS)
    columns = [c for c in TXN.fieldNames() if c not in ("ingested_at", "raw")]
    return _flat(read_transactions(spark, path, columns))


@query
def compacted_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that grew by three appends, compacted."""
    path, target = scratch_path(spark, "transactions"), scratch_path(spark, "compacted")
    txns = event_transactions(spark, sf_dir)
    for period in _periods(txns):
        write_transactions(txns.filter(period), path, BUCKETS)
    compact_transactions(spark, path, target, BUCKETS)
    return _flat(read_transactions(spark, target))


@query
def inserted_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two servings of every event inserted into a table that holds them up to the cutoff."""
    path = scratch_path(spark, "transactions")
    txns = event_transactions(spark, sf_dir)
    write_transactions(txns.filter(F.col("occurred_at") < instant(inputs.CUTOFF)), path, BUCKETS)
    insert_transactions(
        inputs.served_twice(spark, sf_dir), path, BUCKETS, ("page_no", "pos")
    )
    return _flat(read_transactions(spark, path))


@query
def stored_transaction_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "transactions")
    write_transactions(event_transactions(spark, sf_dir), path, BUCKETS)
    return count_transactions(read_transactions(spark, path))


@query
def verified_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older table without city, back-filled and checked."""
    older = event_transactions(spark, sf_dir).drop("city", "raw")
    filled = add_missing_columns(older, {"city": "string", "raw": "string"})
    return require_columns(verify_transactions(filled), {"city": "string"}).agg(
        F.count(F.lit(1)).alias("n"), F.count("city").alias("n_city")
    )


# --- normalisation --------------------------------------------------------------


@query
def normalize_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(union_feeds(inputs.native_feeds(spark, sf_dir), as_of=_as_of()), "error")


@query
def normalize_half_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    flow = union_feeds(inputs.native_feeds(spark, sf_dir), as_of=_as_of(), rounding="half_up")
    return flow.select("idempotency_key", "amount_cents")


@query
def feed_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_counts(
        validate(union_feeds(inputs.native_feeds(spark, sf_dir), as_of=_as_of()))
    )


@query
def feeds_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds to new transactions, against a store that holds feed B already."""
    natives = inputs.native_feeds(spark, sf_dir)
    store = normalize_feed(natives["bank-b"], FEEDS["bank-b"], as_of=_as_of())
    new, _ = feeds_to_transactions(natives, store, as_of=_as_of())
    return _flat(new)


@query
def rfc3339_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    text = rfc3339_text(F.col("ts").cast("timestamp"))
    spaced = F.regexp_replace(text, "T", " ")
    return events.select(
        "event_id",
        text.alias("ts_text"),
        micros(parse_rfc3339(text)).alias("parsed_us"),
        micros(parse_rfc3339(spaced)).alias("rejected_us"),
    )


@query
def amounts_in_dollars(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.col("amount_cents")
    return event_transactions(spark, sf_dir).select(
        "idempotency_key",
        amount_dollars(cents).alias("dollars"),
        dollars_text(cents).alias("dollars_text"),
    )


# --- validation, quarantine, deduplication ----------------------------------------


@query
def validate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate(inputs.dirty_transactions(spark, sf_dir))
    return checked.select("idempotency_key", "account_id", "amount_cents", "error")


@query
def quarantine_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected(validate(inputs.dirty_transactions(spark, sf_dir)))


@query
def failure_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = inputs.deliveries(spark, sf_dir).filter(F.col("error").isNotNull())
    return route_failures(failed, as_of=_as_of()).select(
        "message_id",
        "route",
        "retry_count",
        micros(F.col("available_at")).alias("available_us"),
        "reason",
    )


@query
def retry_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = inputs.deliveries(spark, sf_dir).filter(F.col("error").isNotNull())
    return retries(route_failures(failed, as_of=_as_of())).select("message_id", "retry_count")


@query
def dead_letter_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = inputs.deliveries(spark, sf_dir).filter(F.col("error").isNotNull())
    return dead_letters(route_failures(failed, as_of=_as_of())).select(
        "message_id", "retry_count", "reason"
    )


@query
def delivery_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    tried = route_failures(inputs.deliveries(spark, sf_dir), as_of=_as_of())
    outcome = F.when(F.col("error").isNull(), F.lit("accepted")).otherwise(F.col("route"))
    return outcome_tally(tried.select(outcome.alias("outcome")))


@query
def dedupe_first_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(dedupe_feed(inputs.served_twice(spark, sf_dir)))


@query
def dedupe_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two servings of every event against a store of the events before the cutoff."""
    stored = event_transactions(spark, sf_dir).filter(
        F.col("occurred_at") < instant(inputs.CUTOFF)
    )
    batch = inputs.served_twice(spark, sf_dir)
    return _flat(dedupe_against_store(batch, stored, "page_no", "pos"))


@query
def ingest_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dirty rows and all clean rows in one batch: copies and invalid rows."""
    stored = event_transactions(spark, sf_dir).filter(
        F.col("occurred_at") < instant(inputs.CUTOFF)
    )
    clean = event_transactions(spark, sf_dir)
    batch = validate(inputs.dirty_transactions(spark, sf_dir).unionByName(clean))
    return batch_tally(batch, stored)


# --- history, rules -----------------------------------------------------------------


@query
def account_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    txns = event_transactions(spark, sf_dir).select(*RULE_INPUT)
    return with_history(txns, inputs.DAY.window_seconds).select(
        "idempotency_key", "position", "in_window", "first_use", "prev_city", "prev_us"
    )


@query
def account_history_heavy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five accounts with a fifth of the table each, cut into sorted chunks."""
    history = with_history(
        inputs.type_accounts(spark, sf_dir),
        inputs.HOUR.window_seconds,
        heavy_rows=100,
        chunk_rows=2_000,
    )
    return history.select(
        "idempotency_key", "position", "in_window", "first_use", "prev_city", "prev_us"
    )


@query
def city_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    txns = event_transactions(spark, sf_dir).select(*RULE_INPUT)
    history = with_history(txns, inputs.DAY.window_seconds)
    return with_distance(history).select(
        "idempotency_key", F.round("km", 3).alias("km")
    )


def _one_rule(spark: SparkSession, sf_dir: str, rule: Callable) -> DataFrame:
    fired = score(event_transactions(spark, sf_dir), inputs.DAY, rules=(rule,))
    return fired.select("idempotency_key", "reasons")


@query
def rule_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_rule(spark, sf_dir, velocity)


@query
def rule_mcc_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_rule(spark, sf_dir, mcc_drift)


@query
def rule_geo_impossible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_rule(spark, sf_dir, geo_impossible)


@query
def score_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.scored_flags(spark, sf_dir).select(
        "idempotency_key",
        "account_id",
        "amount_cents",
        "merchant_category",
        micros(F.col("occurred_at")).alias("occurred_us"),
        F.size("flags").alias("n_flags"),
        "reasons",
    )


@query
def score_rules_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules with their fixed thresholds."""
    return score(event_transactions(spark, sf_dir)).select("idempotency_key", "reasons")


@query
def score_rules_heavy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three rules on accounts that are too heavy for one task."""
    txns = inputs.type_accounts(spark, sf_dir)
    fired = score(txns, inputs.HOUR, heavy_rows=100, chunk_rows=2_000)
    return fired.select("idempotency_key", "account_id", "reasons")


@query
def score_rules_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts judged from their first row after the cutoff on, earlier rows aggregated."""
    txns = event_transactions(spark, sf_dir)
    late = txns.filter(F.col("occurred_at") >= instant(inputs.CUTOFF))
    since = late.groupBy("account_id").agg(F.min(micros(F.col("occurred_at"))).alias("since_us"))
    return score(txns, inputs.DAY, since=since).select("idempotency_key", "reasons")


@query
def score_rules_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders have only dates, so rows of one account often share an instant."""
    year = RuleSettings(window_seconds=365 * 86_400)
    fired = score(order_transactions(spark, sf_dir), year)
    return fired.select("idempotency_key", "account_id", "reasons")


# --- flag table and review --------------------------------------------------------------


@query
def flag_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flag table after review, as stored by key bucket and read back."""
    path = scratch_path(spark, "flags")
    replace_flags(inputs.flag_table(spark, sf_dir), path, BUCKETS)
    return _flags_flat(spark.read.parquet(path))


@query
def flag_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most recent flag, looked up by its key in the stored table."""
    path = scratch_path(spark, "flags")
    replace_flags(inputs.flag_table(spark, sf_dir), path, BUCKETS)
    stored = spark.read.parquet(path)
    latest = stored.agg(F.max(F.struct("occurred_at", "idempotency_key")).alias("m")).first()
    found = read_flag(spark, path, latest["m"]["idempotency_key"], BUCKETS)
    return _flags_flat(flag_by_key(found, latest["m"]["idempotency_key"]))


@query
def flags_upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = inputs.earlier_flag_table(spark, sf_dir)
    return _flags_flat(upsert_flags(current, inputs.scored_flags(spark, sf_dir), _as_of()))


@query
def flags_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = inputs.earlier_flag_table(spark, sf_dir)
    return new_flags(current, inputs.scored_flags(spark, sf_dir)).select(
        "idempotency_key", "reasons"
    )


@query
def review_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviewed = review(inputs.flag_table(spark, sf_dir), inputs.decisions(spark, sf_dir))
    return reviewed.select(
        "idempotency_key", "status", micros(F.col("updated_at")).alias("updated_us")
    )


@query
def review_queue_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An unknown status falls back to pending."""
    return _flags_flat(review_queue(inputs.flag_table(spark, sf_dir), "no-such-status"))


@query
def review_queue_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of the denied queue: a top-k."""
    return _flags_flat(review_queue(inputs.flag_table(spark, sf_dir), "denied", 25))


@query
def flags_approved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags_flat(status_filter(inputs.flag_table(spark, sf_dir), "approved"))


@query
def flag_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_counts(inputs.flag_table(spark, sf_dir))


@query
def flags_per_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flags_by_rule(inputs.flag_table(spark, sf_dir))


@query
def reason_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons of every event: NULL without a flag, blanks between on some."""
    flags = inputs.scored_flags(spark, sf_dir).select("idempotency_key", "reasons")
    padded = F.when(
        F.col("merchant_category") == "5411", F.concat(F.col("reasons"), F.lit("\n \n"))
    ).otherwise(F.col("reasons"))
    rows = (
        event_transactions(spark, sf_dir)
        .select("idempotency_key", "merchant_category")
        .join(flags, "idempotency_key", "left")
        .withColumn("reasons", padded)
    )
    reasons = F.col("reasons")
    return rows.select(
        "idempotency_key",
        F.size(reason_list(reasons)).alias("n_listed"),
        reason_count(reasons).alias("n_parts"),
        reasons_display(reasons).alias("reasons_text"),
    )


@query
def risk_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = event_transactions(spark, sf_dir).select(
        "idempotency_key", inputs.fixed_score(F.col("idempotency_key")).alias("ml_score")
    )
    value = F.col("ml_score")
    return scored.select(
        "idempotency_key",
        ml_score_percent(value).alias("percent"),
        risk_band(value).alias("band"),
        score_text(value).alias("score_text"),
    )


@query
def flag_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A damaged flag table: duplicated keys, a status out of range, empty categories."""
    flags = materialize(inputs.flag_table(spark, sf_dir), "flags")
    amount = F.col("amount_cents")
    damaged = flags.withColumns(
        {
            "status": F.when(amount < 1000, F.lit("unknown")).otherwise(F.col("status")),
            "merchant_category": F.when(amount > 9000, F.lit(" ")).otherwise(
                F.col("merchant_category")
            ),
            "account_id": F.when(amount.between(4000, 5000), F.lit(None)).otherwise(
                F.col("account_id")
            ),
        }
    )
    return flag_violations(damaged.unionByName(status_filter(flags, "approved")))


# --- evaluation ---------------------------------------------------------------------------


def _rounded(evaluation: DataFrame) -> DataFrame:
    ratios = ("precision", "recall", "false_positive_rate")
    return evaluation.withColumns({c: F.round(c, 6) for c in ratios})


@query
def evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        evaluate(event_transactions(spark, sf_dir), inputs.flag_table(spark, sf_dir))
    )


@query
def evaluation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(
        evaluate(event_transactions(spark, sf_dir), inputs.flag_table(spark, sf_dir)), 2
    )


@query
def evaluation_undefined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label that never occurs: recall has no denominator."""
    rows = evaluate(
        event_transactions(spark, sf_dir), inputs.flag_table(spark, sf_dir), "no-such-bank"
    )
    return report(rows)


@query
def attack_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_totals(event_transactions(spark, sf_dir))


@query
def flagged_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_totals(inputs.flag_table(spark, sf_dir))


@query
def dashboard_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = dashboard_snapshot(
        event_transactions(spark, sf_dir), inputs.flag_table(spark, sf_dir)
    )
    return _rounded(snapshot["metrics"])


# --- features, split, model ------------------------------------------------------------------


def _labelled(spark: SparkSession, sf_dir: str, flags: DataFrame | None = None) -> DataFrame:
    txns = with_label(event_transactions(spark, sf_dir))
    return with_rule_flag_count(txns, inputs.flag_table(spark, sf_dir) if flags is None else flags)


def _lawful(spark: SparkSession, sf_dir: str, flags: DataFrame | None = None) -> DataFrame:
    """Transactions labelled by a law of three features: what a classifier must find again."""
    txns = _labelled(spark, sf_dir, flags)
    late = weekday(F.unix_micros("occurred_at")) >= 5
    risky = F.col("merchant_category") == HIGH_RISK_CATEGORY
    return txns.withColumn("label", ((risky & late) | (F.col("rule_flag_count") >= 2)).cast("double"))


def _features_flat(features: DataFrame) -> DataFrame:
    return features.select(
        "idempotency_key",
        "amount_cents",
        "hour_of_day",
        "weekday",
        "is_high_risk_mcc",
        "velocity_count",
        "category_seen_before",
        F.round("geo_speed_kmh", 3).alias("geo_speed_kmh"),
        "rule_flag_count",
    )


@query
def rule_flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir).select(
        "idempotency_key", "rule_flag_count", F.col("label").cast("int").alias("label")
    )


@query
def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features_flat(build_features(_labelled(spark, sf_dir), settings=inputs.DAY))


@query
def features_heavy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features_flat(
        build_features(
            inputs.type_accounts(spark, sf_dir),
            settings=inputs.HOUR,
            heavy_rows=100,
            chunk_rows=2_000,
        )
    )


@query
def chrono_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = with_label(event_transactions(spark, sf_dir))
    return chronological_split(labelled).select("idempotency_key", "split")


@query
def chrono_split_heavy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates: the boundary day is one instant, ranked by sorted chunks."""
    urgent = (F.col("merchant_category") == "1-URGENT").cast("double")
    labelled = order_transactions(spark, sf_dir).withColumn("label", urgent)
    return chronological_split(labelled, heavy_rows=1, chunk_rows=2).select(
        "idempotency_key", "split"
    )


@query
def training_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_gate(with_label(event_transactions(spark, sf_dir)))


@query
def pending_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the transactions whose flag has no score."""
    waiting = pending_for_scoring(inputs.flag_table(spark, sf_dir)).select("idempotency_key")
    built = build_features(_labelled(spark, sf_dir), settings=inputs.DAY)
    return _features_flat(built.join(waiting, "idempotency_key", "left_semi"))


@query
def ml_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the split and held-out ratios, of a label that the features explain.

    Trees differ between libraries, but any that learn a law of few values learn it whole.
    """
    metrics = train_and_evaluate(_lawful(spark, sf_dir), settings=inputs.DAY).metrics
    ratios = [F.round(c, 6).alias(c) for c in ("precision", "recall", "auc")]
    return metrics.select("train_size", "test_size", "test_attack_count", *ratios)


@query
def score_rules_null_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows has no account: judged by both routes and since a time alike.

    ``n`` counts the routes that raise a flag with these reasons.
    """
    txns = event_transactions(spark, sf_dir)
    number = F.split_part("idempotency_key", F.lit(":"), F.lit(2)).cast("bigint")
    txns = txns.withColumn("account_id", F.when(number % 3 != 0, F.col("account_id")))
    first = F.min(F.unix_micros("occurred_at")).alias("since_us")
    routes = (
        score(txns, inputs.DAY),
        score(txns, inputs.DAY, heavy_rows=100, chunk_rows=500),
        score(txns, inputs.DAY, since=txns.groupBy("account_id").agg(first)),
    )
    flags = reduce(DataFrame.unionByName, [r.select("idempotency_key", "reasons") for r in routes])
    return flags.groupBy("idempotency_key", "reasons").agg(F.count(F.lit(1)).alias("n"))


@query
def account_history_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row twice under one key: both routes must give the same rows."""
    once = event_transactions(spark, sf_dir)
    twice = once.unionByName(once)
    columns = ["idempotency_key", "position", "in_window", "first_use"]
    light = with_history(twice, inputs.DAY.window_seconds).select(*columns)
    heavy = with_history(twice, inputs.DAY.window_seconds, heavy_rows=100, chunk_rows=700).select(*columns)
    return light.unionByName(heavy).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


@query
def held_out_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics on fixed scores, so that they can be checked exactly."""
    score_of = inputs.fixed_score(F.col("idempotency_key"))
    rows = (
        with_label(event_transactions(spark, sf_dir))
        .select("idempotency_key", "label", F.coalesce(score_of, F.lit(0.0)).alias("ml_score"))
        .withColumn("predicted", (F.col("ml_score") >= DECISION_THRESHOLD).cast("int"))
    )
    ratios = ("precision", "recall", "auc")
    return held_out_metrics(rows).withColumns({c: F.round(c, 6) for c in ratios})


def _stored_model(spark: SparkSession, sf_dir: str, flags: DataFrame | None = None):
    txns = _lawful(spark, sf_dir, flags).select(*FEATURE_INPUT, "label")
    rows = materialize(txns, "labelled")
    built = materialize(build_features(rows, settings=inputs.DAY), "features")
    path = scratch_path(spark, "model")
    save_model(train(built), path)
    return load_model(path)


def _called() -> Column:
    """What the score says; null where there is none."""
    return (F.col("ml_score") >= DECISION_THRESHOLD).alias("called")


@query
def ml_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model saved, loaded and applied to the flags without a score."""
    flags = materialize(inputs.flag_table(spark, sf_dir), "flags")
    model = _stored_model(spark, sf_dir, flags)
    scored = score_pending(flags, event_transactions(spark, sf_dir), model, settings=inputs.DAY)
    return scored.select("idempotency_key", _called())


# --- streams ------------------------------------------------------------------------------------


def _clock(batch_id: int) -> datetime:
    return datetime(2024, 2, 1, tzinfo=timezone.utc) + timedelta(minutes=batch_id)


def _drain(writer) -> None:
    running = writer.trigger(availableNow=True).start()
    running.awaitTermination()


DELIVERIES = 3


def _periods(txns: DataFrame) -> list[Column]:
    """Conditions that cut the rows into periods of equal length, from their first time to the last."""
    us = F.unix_micros("occurred_at")
    least, most = txns.agg(F.min(us), F.max(us)).first()
    if least is None:
        return [F.lit(True)]
    step = (most - least) // DELIVERIES + 1
    return [
        (us >= least + k * step) & (us < least + (k + 1) * step) for k in range(DELIVERIES)
    ]


def _thirds(stored: DataFrame) -> int:
    """How many files make a third of a stored table: one micro-batch of three."""
    return max(1, math.ceil(len(stored.inputFiles()) / DELIVERIES))


def _land_messages(spark: SparkSession, sf_dir: str) -> str:
    """Envelopes of all events in three deliveries, each delivery followed by a copy."""
    path = scratch_path(spark, "messages")
    txns = event_transactions(spark, sf_dir)
    for period in _periods(txns):
        messages = to_envelope(txns.filter(period)).persist()
        messages.write.mode("append").json(path)
        messages.write.mode("append").json(path)
        messages.unpersist()
    return path


def _landed_store(spark: SparkSession, sf_dir: str) -> Store:
    """All events as history, loaded in three parts."""
    store = Store(scratch_path(spark, "store"), BUCKETS)
    txns = event_transactions(spark, sf_dir)
    for period in _periods(txns):
        load_history(txns.filter(period), store)
    return store


@query
def history_loaded_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(read_transactions(spark, _landed_store(spark, sf_dir).transactions))


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message twice through the ingest stream, in several batches; each is stored once."""
    path = _land_messages(spark, sf_dir)
    store = Store(scratch_path(spark, "store"), BUCKETS)
    some = _thirds(spark.read.text(path))
    _drain(ingest_stream(read_message_files(spark, path, some), store, _clock))
    return _flat(read_transactions(spark, store.transactions))


@query
def ingest_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of dirty rows, every message served twice, counted while they are staged."""
    store = Store(scratch_path(spark, "store"), BUCKETS)
    messages = to_envelope(inputs.dirty_transactions(spark, sf_dir))
    for k in range(2):
        ingest_batch(messages, k, store, _clock(k))
    tally = read_batches(spark, store.tally, TALLY)
    return tally.groupBy("outcome").agg(F.sum("n").alias("n"))


@query
def stream_retry_timers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failing deliveries go round through state timers until they are stored or given up.

    A third fails once, one in a thousand always. The messages come in three batches, and
    each round of due ones is a batch more.
    """
    use_rocksdb_state(spark)
    store, path = Store(scratch_path(spark, "store"), BUCKETS), scratch_path(spark, "messages")
    files = max(4, spark.sparkContext.defaultParallelism)
    txns = event_transactions(spark, sf_dir)
    for period in _periods(txns):
        to_envelope(txns.filter(period)).repartition(files).write.mode("append").json(path)

    def failing() -> Column:
        number = F.col("native_id").cast("bigint")
        once = (number % 3 == 0) & (F.col("retry_count") == 0)
        return F.when(once | (number % 1000 == 13), F.lit("busy"))

    with state_partitions(spark):
        for _ in range(4):
            messages = read_message_files(spark, path, files)
            _drain(ingest_stream(messages, store, _clock, failing, timers=True))
            # Timers of processing time never run out of batches, so each round is one.
            again = retry_stream(read_failures(spark, store), store).trigger(once=True)
            again.start().awaitTermination()
    stored = read_transactions(spark, store.transactions).select("idempotency_key", F.lit("stored").alias("outcome"))
    given_up = read_batches(spark, store.quarantine).select(
        F.col("message_id").alias("idempotency_key"), F.col("reason").alias("outcome")
    )
    return stored.unionByName(given_up)


@query
def dated_look_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one day and the day's look-back before it, from the table by date and account."""
    path = scratch_path(spark, "dated")
    write_dated_transactions(event_transactions(spark, sf_dir), path, BUCKETS)
    first = datetime.fromisoformat(inputs.CUTOFF).replace(tzinfo=timezone.utc)
    last = first + timedelta(hours=23)
    seconds = inputs.DAY.window_seconds
    return _flat(read_dated_transactions(spark, path, first, last, seconds))


@query
def stream_ingest_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches with failing deliveries, each replayed with a later clock and another failure.

    A third of the deliveries fails in the first attempt, others in the replay. What the
    first attempt decided must hold, and the retries store the rest.
    """
    store = Store(scratch_path(spark, "store"), BUCKETS)
    txns = event_transactions(spark, sf_dir)
    batches = [to_envelope(txns.filter(p)) for p in _periods(txns)]
    none = batches[0].limit(0)

    def failing(third: int):
        place = F.pmod(F.xxhash64("message_id"), F.lit(3))
        return lambda: F.when((place == third) & (F.col("retry_count") == 0), F.lit("busy"))

    for k, batch in enumerate([*batches, none]):
        ingest_batch(batch, k, store, _clock(k), failing(0))
        ingest_batch(batch, k, store, _clock(k) + timedelta(hours=1), failing(1))
    return _flat(read_transactions(spark, store.transactions))


@query
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scoring stream over the stored table in three batches, then the flag table it leaves."""
    store = _landed_store(spark, sf_dir)
    some = _thirds(spark.read.parquet(store.transactions))
    source = read_transaction_files(spark, store.transactions, some)
    _drain(score_stream(source, store, _clock, inputs.DAY))
    return current_flags(spark, store).select("idempotency_key", "reasons", "status")


@query
def dashboard_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review page's numbers after several batches of rows, flags and decisions."""
    use_rocksdb_state(spark)
    store = _landed_store(spark, sf_dir)
    some = _thirds(spark.read.parquet(store.transactions))
    source = read_transaction_files(spark, store.transactions, some)
    _drain(score_stream(source, store, _clock, inputs.DAY))
    # Earlier and later decisions on the same keys, most of them on keys without a flag.
    decided = inputs.decisions(spark, sf_dir)
    for part in (F.minute("decided_at") % 2 == 0, F.minute("decided_at") % 2 == 1):
        record_decisions(decided.filter(part).repartition(2), store)
    with state_partitions(spark):
        _drain(
            change_stream(
                read_transaction_files(spark, store.transactions, some),
                read_flag_feed(spark, store.flags, _thirds(spark.read.parquet(store.flags))),
                read_decisions(spark, store, 2),
                store,
            )
        )
    return current_numbers(spark, store)


@query
def stream_score_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classifier stream over the change feed of the scoring stream."""
    model = _stored_model(spark, sf_dir)
    store = Store(scratch_path(spark, "store"), BUCKETS)
    load_history(event_transactions(spark, sf_dir), store)
    source = read_transaction_files(spark, store.transactions)
    _drain(score_stream(source, store, _clock, inputs.DAY))
    feed = read_flag_feed(spark, store.flags)
    _drain(score_pending_stream(feed, store, model, inputs.DAY))
    return read_scores(spark, store).select("idempotency_key", _called())


@query
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row served three times: at once, soon after, and when its state is long gone.

    The bounded filter in front forgets a key after a day of event time, a thirtieth of the
    data; the third serving is found by the index, which forgets none.
    """
    # Every core writes and reads a part of each serving; the micro-batches stay the same.
    path, files = scratch_path(spark, "served"), max(4, spark.sparkContext.defaultParallelism)
    txns = event_transactions(spark, sf_dir).withColumn("served_at", F.col("occurred_at"))
    for period in _periods(txns):
        rows = txns.filter(period).persist()
        for _ in range(2):
            rows.repartition(files).write.mode("append").parquet(path)
        rows.unpersist()
    later = txns.withColumn("served_at", F.col("occurred_at") + F.expr("interval 60 days"))
    later.repartition(files).write.mode("append").parquet(path)
    store = Store(scratch_path(spark, "store"), BUCKETS)
    served = spark.readStream.schema(txns.schema).option("maxFilesPerTrigger", files).parquet(path)
    with state_partitions(spark):
        _drain(dedupe_stream(drop_recent_duplicates(served, "served_at", "1 day"), store))
    return read_transactions(spark, store.transactions).select(
        "idempotency_key", micros(F.col("occurred_at")).alias("occurred_us")
    )


@query
def stream_poison_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries with amounts that are no numbers in some rows: these are set aside.

    A strict cast fails on such a row, and with it the whole micro-batch. All other rows of
    that batch and of the later ones are stored.
    """
    path, files = scratch_path(spark, "amounts"), 4
    poison, store = scratch_path(spark, "poison"), Store(scratch_path(spark, "store"), BUCKETS)
    txns = event_transactions(spark, sf_dir)
    is_bad = F.col("native_id").cast("bigint") % 2500 == 7
    text = F.when(is_bad, F.lit("n/a")).otherwise(F.col("amount_cents").cast("string"))
    rows = txns.withColumn("amount_cents", text)
    for period in _periods(txns):
        rows.filter(period).repartition(files).write.mode("append").parquet(path)

    def read_amounts(batch: DataFrame) -> DataFrame:
        return batch.withColumn("amount_cents", F.col("amount_cents").cast("bigint"))

    def no_number(batch: DataFrame) -> Column:
        return batch["amount_cents"].isNotNull() & batch["amount_cents"].try_cast("bigint").isNull()

    def keep(batch: DataFrame, batch_id: int) -> None:
        remember(store_new(read_amounts(batch), batch_id, store), batch_id, store)

    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)
    run = isolated(keep, read_amounts, poison, suspect=no_number)
    _drain(stream.writeStream.foreachBatch(run).option("checkpointLocation", store.progress("amounts")))
    stored = read_transactions(spark, store.transactions).select("idempotency_key", F.lit("stored").alias("outcome"))
    found = read_poison(spark, poison, rows.schema)
    named = F.when(F.col("error").contains("CAST_INVALID_INPUT"), "poison").otherwise(F.col("error"))
    return stored.unionByName(found.select("idempotency_key", named.alias("outcome")))


@query
def chrono_split_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split of all events after three loads, from the counts kept with each load."""
    store = _landed_store(spark, sf_dir)
    some = _thirds(spark.read.parquet(store.transactions))
    _drain(day_stream(read_transaction_files(spark, store.transactions, some), store))
    labelled = with_label(event_transactions(spark, sf_dir))
    return apply_split(labelled, current_boundaries(spark, store)).select("idempotency_key", "split")


def _land_arrivals(spark: SparkSession, txns: DataFrame) -> tuple[str, int]:
    """Rows in three deliveries by time, then a far-off row of nobody, which moves the watermark.

    Also returns the number of files of a delivery.
    """
    path, files = scratch_path(spark, "arrivals"), 4
    rows = txns.select(*RULE_INPUT)
    for period in _periods(rows):
        rows.filter(period).repartition(files).write.mode("append").parquet(path)
    last = rows.agg(
        F.lit("nobody:0").alias("idempotency_key"),
        F.lit("nobody").alias("account_id"),
        F.lit(1).cast("bigint").alias("amount_cents"),
        F.lit("").alias("merchant_category"),
        F.lit(None).cast("string").alias("city"),
        (F.max("occurred_at") + F.expr("interval 60 days")).alias("occurred_at"),
    )
    last.write.mode("append").parquet(path)
    return path, files


def _stateful_flags(spark: SparkSession, txns: DataFrame, past: Summary | None) -> DataFrame:
    """What the stateful rules flag with a delay of a day, far shorter than the data."""
    use_rocksdb_state(spark)
    out = scratch_path(spark, "flagged")
    path, files = _land_arrivals(spark, txns)
    arrivals = (
        spark.readStream.schema(txns.select(*RULE_INPUT).schema)
        .option("maxFilesPerTrigger", files)
        .parquet(path)
    )
    with state_partitions(spark):
        _drain(
            rules_stateful(arrivals, 86_400, inputs.DAY, past=past)
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", scratch_path(spark, "progress"))
        )
    return spark.read.parquet(out).select("idempotency_key", "account_id", "reasons")


@query
def stream_rules_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules with per-account state over several deliveries, rows shuffled inside each."""
    return _stateful_flags(spark, event_transactions(spark, sf_dir), None)


@query
def stream_rules_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the cutoff on, started from the summary of what is stored before."""
    txns = event_transactions(spark, sf_dir)
    stored = F.col("occurred_at") < instant(inputs.CUTOFF)
    past = summarize(txns.filter(stored), inputs.DAY.window_seconds)
    return _stateful_flags(spark, txns.filter(~stored), past)

