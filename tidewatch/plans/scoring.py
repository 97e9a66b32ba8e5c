"""Transactions in, scored transactions out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewatch.config import RuleConfig
from tidewatch.operators import rapid_fire, rules
from tidewatch.operators.history import PREVIOUS_LOCATION, add_history, heavy_users
from tidewatch.operators.routing import combine_flags, label_reason
from tidewatch.operators.validate import valid_rows


def score_transactions(df: DataFrame, config: RuleConfig) -> DataFrame:
    """Apply the active rules to all scorable rows.

    Rows that cannot be scored are left to ``operators.validate.rejected_rows``;
    clean, alerts and rejects together are the input, row for row.
    """
    location = "location_anomaly" in config.rules
    rapid = "rapid_fire" in config.rules
    scored = valid_rows(df, config.max_ahead_seconds)
    if location or rapid:
        previous = PREVIOUS_LOCATION if location else {}
        heavy = heavy_users(df, config)  # of all rows: reads the user column alone
        scored = add_history(scored, config, heavy, previous=previous, counts=rapid)
    return apply_rules(scored, config)


def apply_rules(df: DataFrame, config: RuleConfig) -> DataFrame:
    """Flags, decision and label for rows that already carry their history."""
    if "high_value" in config.rules:
        df = rules.flag_high_value(df, config)
    if "rapid_fire" in config.rules:
        df = rapid_fire.add_flag(df, config)
    if "location_anomaly" in config.rules:
        df = rules.flag_distance(df, config)
    return label_reason(combine_flags(df, config), config)
