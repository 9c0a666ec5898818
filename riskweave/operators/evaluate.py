"""Precision, recall and false-positive rate against labelled attack rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.constants import ATTACK_BANK
from riskweave.functions import percent_text

COUNTS = ("attack_transactions", "legit_transactions", "attack_flagged", "legit_flagged")


def label_totals(txns: DataFrame, attack_bank: str = ATTACK_BANK) -> DataFrame:
    attack = F.col("bank") == attack_bank
    return txns.agg(
        F.count_if(attack).alias("attack_transactions"),
        F.count_if(~attack).alias("legit_transactions"),
    )


def flag_totals(flags: DataFrame, attack_bank: str = ATTACK_BANK) -> DataFrame:
    attack = F.col("idempotency_key").startswith(f"{attack_bank}:")
    return flags.agg(
        F.count_if(attack).alias("attack_flagged"), F.count_if(~attack).alias("legit_flagged")
    )


def ratios(counts: DataFrame) -> DataFrame:
    """Add the three ratios; NULL where the denominator is zero."""
    flagged = F.col("attack_flagged") + F.col("legit_flagged")

    def ratio(part: Column, whole: Column) -> Column:
        return F.try_divide(part.cast("double"), whole.cast("double"))

    return counts.select(
        *COUNTS,
        ratio(F.col("attack_flagged"), flagged).alias("precision"),
        ratio(F.col("attack_flagged"), F.col("attack_transactions")).alias("recall"),
        ratio(F.col("legit_flagged"), F.col("legit_transactions")).alias("false_positive_rate"),
    )


def evaluate(txns: DataFrame, flags: DataFrame, attack_bank: str = ATTACK_BANK) -> DataFrame:
    """One row of counts and ratios.

    The two one-row totals are stacked and summed, so there is no join.
    """
    stacked = label_totals(txns, attack_bank).unionByName(
        flag_totals(flags, attack_bank), allowMissingColumns=True
    )
    return ratios(stacked.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS]))


def report(evaluation: DataFrame, rate_decimals: int = 1) -> DataFrame:
    """The evaluation with its ratios as percentage texts."""
    return evaluation.select(
        *COUNTS,
        percent_text(F.col("precision")).alias("precision"),
        percent_text(F.col("recall")).alias("recall"),
        percent_text(F.col("false_positive_rate"), rate_decimals).alias("false_positive_rate"),
    )
