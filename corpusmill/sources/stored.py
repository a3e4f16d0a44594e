"""What is finished or present, kept as a table that joins without moving it
(JON-01, JON-02, JON-04).

Each run appends its rows to a Parquet table that is bucketed and sorted by
the key. An existence join then shuffles the new, wanted side into the
table's buckets; the history, which only grows, stays where it is. The
operators of ``planning`` take the table as it is.

The files lie under a folder of the caller's choice (shared storage) and
carry their buckets; the catalogue entry is made again where a session does
not know it. The number of buckets is part of the folder's name, so that two
layouts never mix.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

BUCKETS = 1024  # for a large history; about 100 million keys are 10 MB a bucket


@dataclass(frozen=True)
class KeyStore:
    """A stored table: ``schema`` (DDL with the key), ``key``, ``buckets``."""

    folder: str
    key: str = "path"
    schema: str = "path STRING, length BIGINT"
    buckets: int = BUCKETS

    @property
    def location(self) -> str:
        return f"{self.folder.rstrip('/')}/by_{self.key}_{self.buckets}"

    @property
    def table(self) -> str:
        return "corpusmill_keys_" + hashlib.sha256(self.location.encode()).hexdigest()[:16]

    def read(self, spark: SparkSession) -> DataFrame:
        """The table; empty before the first run."""
        at = self.location.replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({self.schema}) USING parquet "
                  f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{at}'")
        spark.catalog.refreshTable(self.table)  # runs of other sessions
        return spark.table(self.table)

    def append(self, rows: DataFrame) -> None:
        """Adds a run's rows (those without a key are left out). They are
        brought together by bucket first: one file a bucket and run."""
        known = self.read(rows.sparkSession)
        rows.select(*known.columns).where(f"`{self.key}` IS NOT NULL").repartition(self.buckets, self.key) \
            .write.format("parquet").mode("append").bucketBy(self.buckets, self.key).sortBy(self.key) \
            .option("path", self.location).saveAsTable(self.table)
