"""Job settings, read from environment variables with plain defaults."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    """Every field can be overridden by the environment variable of the same upper-case name."""

    database_url: str = "jdbc:postgresql://localhost:5432/analytics"
    kafka_bootstrap_servers: str = "localhost:9092"
    kafka_topic_user_events: str = "user_events"
    kafka_topic_analytics: str = "analytics_events"
    s3_bucket: str = ""
    gcs_bucket: str = ""
    poll_records: int = 0  # records per trigger; 0 reads all that is available
    checkpoint_interval: int = 60
    window_duration: int = 300
    slide_duration: int = 60
    watermark: str = "1 hour"

    @classmethod
    def from_env(cls, env=os.environ) -> "Settings":
        found = {}
        for f in fields(cls):
            raw = env.get(f.name.upper())
            if raw is not None:
                found[f.name] = int(raw) if f.type == "int" else raw
        return cls(**found)
