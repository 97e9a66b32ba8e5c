"""Run the scoring stream until stopped: ``python -m tidewatch.streaming.service``.

Settings come from the environment (see ``config``). Needs the Kafka connector.
"""

from __future__ import annotations

import logging

from tidewatch.config import RuleConfig, StreamConfig
from tidewatch.session import build_session
from tidewatch.sources.messages import kafka_stream
from tidewatch.streaming.pipeline import start_rapid_fire, start_scoring


def main() -> None:
    logging.basicConfig(level=logging.INFO)
    rules, stream = RuleConfig.from_env(), StreamConfig.from_env()
    spark = build_session()
    start_scoring(kafka_stream(spark, stream), rules, stream)
    start_rapid_fire(kafka_stream(spark, stream), rules, stream)
    logging.info("scoring %s into %s", stream.topic, stream.output_path)
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
