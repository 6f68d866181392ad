"""The functions that are not built in, for use from SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register(spark: SparkSession) -> None:
    """host_to_ascii(entry): hosts with other letters in punycode. yaml_payload(body): the payload list of a YAML body."""
    from ..sources.formats import yaml_payload
    from .hosts import _to_ascii

    spark.udf.register("host_to_ascii", _to_ascii)
    spark.udf.register("yaml_payload", yaml_payload)
