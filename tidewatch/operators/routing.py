"""Decision, label, and the split into clean rows and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.config import FLAG_COLUMNS, RuleConfig
from tidewatch.functions.flags import any_flag, fill_flags, reason_label


def combine_flags(df: DataFrame, config: RuleConfig) -> DataFrame:
    """Add ``is_fraud``: any flag of the active rules, never NULL."""
    columns = [FLAG_COLUMNS[rule] for rule in config.ordered_rules]
    return fill_flags(df, columns).withColumn("is_fraud", any_flag(columns))


def label_reason(df: DataFrame, config: RuleConfig) -> DataFrame:
    """Add ``fraud_reason``: the raised rules joined by ``+``, NULL if none."""
    flags = {rule: FLAG_COLUMNS[rule] for rule in config.ordered_rules}
    return df.withColumn("fraud_reason", reason_label(flags))


def clean_rows(scored: DataFrame) -> DataFrame:
    return scored.filter(~F.col("is_fraud"))


def alert_rows(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("is_fraud"))
