"""Folders for what a query writes and reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from touchline.session import ensure_checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/touchline/{name}-{uuid.uuid4().hex}"
