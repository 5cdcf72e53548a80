"""A generated company file with planted defects, and the time that it takes through all stages."""

from __future__ import annotations

import shutil
import tempfile
import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import Store
from . import runs

COLUMNS = ("company_name", "email", "phone", "website", "street_address", "city", "postal_code", "employee_count", "founded_year", "description")


def companies(spark: SparkSession, rows: int) -> DataFrame:
    """rows x 10 strings: every 31st phone is filler, every 53rd address has lost its spaces, every 7th email is N/A,
    every 5th website is blank, every 3rd postal code has leading zeros."""
    i = F.col("id")
    n = i.cast("string")
    return spark.range(rows).select(
        F.concat(F.lit("Company "), n).alias("company_name"),
        F.when(i % 7 == 0, "N/A").otherwise(F.concat(F.lit("sales"), n, F.lit("@firm"), n, F.lit(".com"))).alias("email"),
        F.when(i % 31 == 0, "0000000000").otherwise(F.concat(F.lit("+1555"), F.lpad(n, 7, "0"))).alias("phone"),
        F.when(i % 5 == 0, "").otherwise(F.concat(F.lit("https://www.firm"), n, F.lit(".com/"))).alias("website"),
        F.when(i % 53 == 0, F.concat(n, F.lit(" NorthMainStreetWest"))).otherwise(F.concat(n, F.lit(" North Main St"))).alias("street_address"),
        F.concat(F.lit("Town "), (i % 100).cast("string")).alias("city"),
        F.when(i % 3 == 0, "00501").otherwise("10001").alias("postal_code"),
        (i % 5000 + 1).cast("string").alias("employee_count"), (i % 100 + 1900).cast("string").alias("founded_year"),
        F.concat(F.lit("Makes thing "), n).alias("description"),
    )


def run(spark: SparkSession, rows: int) -> float:
    """Seconds for a file of that many rows from ingestion to golden values."""
    root = tempfile.mkdtemp(prefix="goldweave-bench-")
    try:
        companies(spark, rows).coalesce(1).write.csv(f"file://{root}/in.csv", header=True)
        began = time.time()
        runs.run_file(Store(spark, f"file://{root}/db"), f"file://{root}/in.csv", "company", "bench", at=datetime(2024, 1, 1, tzinfo=timezone.utc))
        return time.time() - began
    finally:
        shutil.rmtree(root, ignore_errors=True)
