"""Settings, passed explicitly to every operator that needs them."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

# Environment names and default limits below; rule names, in label order, and the flag column of each.
RULES = ("high_value", "rapid_fire", "location_anomaly")
FLAG_COLUMNS = {
    "high_value": "fraud_high_value",
    "rapid_fire": "fraud_rapid_fire",
    "location_anomaly": "fraud_location_anomaly",
}
DEFAULT_RULES = ("high_value", "location_anomaly")


# A row may be dated this much after its arrival, for clocks that run ahead.
MAX_AHEAD_SECONDS = 600


@dataclass(frozen=True)
class RuleConfig:
    """Rule limits. All comparisons are strict (``value > limit``).

    A row dated more than ``max_ahead_seconds`` after its arrival is a reject.

    ``segment_rows`` is the size above which one user's rows are split over
    several tasks (see ``operators.history``). ``None`` skips the check for
    such users: one pass over the input fewer, for data known to be even.
    """

    amount_limit: float = 10_000.0
    rapid_limit: int = 5
    rapid_window_seconds: int = 60
    rapid_slide_seconds: int = 30
    distance_limit_km: float = 500.0
    rules: tuple[str, ...] = DEFAULT_RULES
    segment_rows: int | None = 1_000_000
    max_ahead_seconds: int = MAX_AHEAD_SECONDS

    def __post_init__(self) -> None:
        unknown = set(self.rules) - set(RULES)
        if unknown:
            raise ValueError(f"unknown rules: {sorted(unknown)}")
        if self.rapid_slide_seconds <= 0 or self.rapid_window_seconds % self.rapid_slide_seconds:
            raise ValueError("the window must be a whole number of slides")

    @property
    def ordered_rules(self) -> tuple[str, ...]:
        return tuple(rule for rule in RULES if rule in self.rules)

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, **overrides) -> RuleConfig:
        env = os.environ if env is None else env
        settings = {
            "amount_limit": float(env.get("FRAUD_THRESHOLD", cls.amount_limit)),
            "rapid_limit": int(env.get("RAPID_TXN_LIMIT", cls.rapid_limit)),
            "distance_limit_km": float(env.get("LOCATION_KM_LIMIT", cls.distance_limit_km)),
        }
        return cls(**{**settings, **overrides})


@dataclass(frozen=True)
class StreamConfig:
    """Where messages come from, where results go, and how often.

    ``max_per_trigger`` bounds a micro-batch (messages for Kafka, files for a
    file source); it is what bounds the rows of one user that a single state
    call sees. ``fail_on_data_loss`` defaults to true: lost offsets are an error
    unless the caller accepts them. A user unseen for ``state_ttl_seconds`` of the
    clock is forgotten, and their next row is a first row; None forgets nobody. It
    is fixed for the life of a checkpoint, and needs a timed trigger.

    With ``ordered``, rows wait for the watermark and are scored in time order, in panes of
    ``pane_seconds`` (see ``streaming.release``); without, as they come.

    With ``partial_reports``, each batch writes its share of the reports beside its rows (see
    ``plans.partials``). With ``batch_records``, a batch is recorded with its counts when all its
    tables are written, for readers that want whole batches (see ``sources.tables.load_recorded``).
    """

    bootstrap_servers: str = "localhost:9092"
    topic: str = "transactions"
    output_path: str = "./output"
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = True
    max_per_trigger: int | None = 5_000_000
    trigger: str = "30 seconds"
    watermark: str = "10 minutes"
    checkpoint_path: str | None = None
    state_ttl_seconds: int | None = None
    ordered: bool = False
    pane_seconds: int = 30
    partial_reports: bool = False
    batch_records: bool = False

    @property
    def checkpoint_base(self) -> str:
        return self.checkpoint_path or f"{self.output_path}/_checkpoints"

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, **overrides) -> StreamConfig:
        env = os.environ if env is None else env
        settings = {
            "bootstrap_servers": env.get("KAFKA_BOOTSTRAP_SERVERS", cls.bootstrap_servers),
            "topic": env.get("KAFKA_TOPIC", cls.topic),
            "output_path": env.get("OUTPUT_PATH", cls.output_path),
        }
        return cls(**{**settings, **overrides})
