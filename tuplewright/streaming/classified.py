"""Routing on a stream of documents: stateless, so the batch operators apply."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import routing
from ..sources.files import RAW


def classified_stream(spark: SparkSession, path: str) -> DataFrame:
    """New JSON-lines files in ``path``, as routed pairs."""
    return routing.classify(routing.explode_documents(spark.readStream.schema(RAW).json(path)))
