"""Fresh folders for queries that write files and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from ..session import shared_folder


def scratch_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/voxmill-files-{uuid.uuid4().hex}"
