"""Whole flows composed from the operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame

from riskweave.constants import RuleSettings
from riskweave.operators.dedupe import dedupe_against_store, dedupe_feed
from riskweave.operators.features import with_label
from riskweave.operators.flags import upsert_flags, with_rule_flag_count
from riskweave.operators.model import Trained, load_model, save_model, score_pending, train_and_evaluate
from riskweave.operators.normalize import union_feeds
from riskweave.operators.rules import score
from riskweave.operators.validate import accepted, rejected, validate
from riskweave.schemas import TXN
from riskweave.sources.feeds import Feed, delivery_gaps, explode_pages


def feeds_to_transactions(
    natives: Mapping[str, DataFrame], store: DataFrame, *, as_of: Column, rounding: str = "truncate"
) -> tuple[DataFrame, DataFrame]:
    """New transactions of a feed delivery, and the rows to quarantine.

    Paged feeds carry ``page_no`` and ``pos`` and are cut to the first serving of
    each record. Validation comes before deduplication.
    """
    flow = validate(union_feeds(natives, as_of=as_of, rounding=rounding))
    good = accepted(flow)
    if {"page_no", "pos"} <= set(good.columns):
        good = dedupe_feed(good)
    new = dedupe_against_store(good, store, "occurred_at", "raw")
    return new.select(*TXN.fieldNames()), rejected(flow)


def complete_pages(pages: DataFrame, feed: Feed) -> DataFrame:
    """The records of a paged delivery; an incomplete one is an error and gives none."""
    gaps = delivery_gaps(pages, feed).orderBy("page_no").limit(5).collect()
    if gaps:
        listed = ", ".join(f"page {r['page_no']}: {r['problem']}" for r in gaps)
        raise ValueError(f"incomplete delivery of {feed.bank}: {listed}")
    return explode_pages(pages, feed)


def rescore(
    txns: DataFrame, current: DataFrame, *, as_of: Column, settings: RuleSettings | None = None
) -> DataFrame:
    """The flag table after scoring every stored transaction."""
    return upsert_flags(current, score(txns, settings), as_of)


def train_and_rescore(
    txns: DataFrame, flags: DataFrame, path: str, *, settings: RuleSettings | None = None, **training
) -> tuple[Trained, DataFrame]:
    """The classifier from gate to flags: train on all transactions, save, score what is unscored.

    Fails before training if there are too few rows or only one label. The flags are scored
    with the model as it was stored under ``path``.
    """
    labelled = with_rule_flag_count(with_label(txns), flags)
    trained = train_and_evaluate(labelled, settings=settings, **training)
    save_model(trained.model, path)
    return trained, score_pending(flags, txns, load_model(path), settings=settings)
