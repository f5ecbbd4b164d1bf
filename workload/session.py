"""Where the queries leave their intermediate tables."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def with_scratch(query: Query) -> Query:
    """The query, in a session that has a scratch folder.

    On a cluster ``spark.checkpoint.dir`` names a folder that all executors
    share. Only a session without executors of their own, as in tests, gets a
    temporary one if it has none.
    """

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        context = spark.sparkContext
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if named is None and (context.master == "local" or context.master.startswith("local[")):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="surveysieve-"))
        return query(spark, sf_dir)

    return run
