"""Queries of this subpackage by name, with their SQL where SQL can say it."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return run

    return register


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, where the job wasn't started with its folder on their path.

    The archive of sources is served by Spark from the driver, as with ``--py-files``.
    """
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    known = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if str(root) in [*known, os.getcwd()] or getattr(context, "_ticklake_shipped", False):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="ticklake-"), "ticklake_sources.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted((root / "ticklake").rglob("*.py")):
            out.write(source, source.relative_to(root))
    context.addPyFile(archive)
    context._ticklake_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
