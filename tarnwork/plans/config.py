"""Settings of a job from the environment and from the session, and a structured log."""

from __future__ import annotations

import json
import logging
import os
from dataclasses import fields

from pyspark.sql import SparkSession

from .job import Settings

PREFIX = "TARNWORK_"


def settings_from(spark: SparkSession | None = None, environment: dict[str, str] | None = None) -> Settings:
    """Settings whose numbers come from TARNWORK_<NAME> variables, over them spark.tarnwork.<name> of the session."""
    environment, out = dict(os.environ) if environment is None else environment, Settings()
    for f in fields(Settings):
        kind = type(getattr(out, f.name))
        if kind not in (int, float):
            continue
        value = environment.get(PREFIX + f.name.upper())
        if spark is not None:
            value = spark.conf.get(f"spark.tarnwork.{f.name}", value)
        if value is not None:
            setattr(out, f.name, kind(value))
    return out


class JsonFormatter(logging.Formatter):
    """One JSON object a line: time, level, event, and what was given as extra={"fields": {...}}."""

    def format(self, record: logging.LogRecord) -> str:
        return json.dumps({"time": self.formatTime(record), "level": record.levelname.lower(), "event": record.getMessage(), **getattr(record, "fields", {})}, default=str)


def log_to(stream=None, level: int = logging.INFO) -> logging.Logger:
    logger = logging.getLogger("tarnwork")
    handler = logging.StreamHandler(stream)
    handler.setFormatter(JsonFormatter())
    logger.handlers[:] = [handler]
    logger.setLevel(level)
    return logger
