"""State in buckets of its key, which joins by the key read where they lie."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from syncloom.schemas import conform


class BucketedTable:
    """Versions of a table, each a folder of files by bucket of the key.

    Rows of a key lie in one bucket, by the hash that Spark's own shuffles deal rows out by. A join
    with the table by its key shuffles the other side alone, into the table's buckets; the table's
    rows stay where they are. A version is written once; which one counts is the caller's to say,
    as the state's pointer does.
    """

    def __init__(
        self, spark: SparkSession, root: str, ddl: str, keys: Sequence[str], buckets: int = 64
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.ddl = ddl
        self.keys = list(keys)
        self.buckets = buckets

    def write(self, df: DataFrame, version: int) -> DataFrame:
        """Rows as a version; each key once. Rows that lie by bucket already are not shuffled."""
        name = f"bucketed_{uuid4().hex}"
        rows = conform(df, self.ddl)
        (
            rows.write.format("parquet")
            .bucketBy(self.buckets, *self.keys)
            .sortBy(*self.keys)
            .option("path", f"{self.root}/version={version}")
            .saveAsTable(name)
        )
        return self.spark.table(name)

    def read(self, version: int) -> DataFrame:
        """A version, with what Spark has to know of its buckets."""
        name = f"bucketed_{uuid4().hex}"
        by = ", ".join(f"`{k}`" for k in self.keys)
        self.spark.sql(
            f"CREATE TABLE {name} ({self.ddl}) USING parquet "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.root}/version={version}'"
        )
        return self.spark.table(name)

    def upsert(self, state: DataFrame, changes: DataFrame, version: int) -> DataFrame:
        """A further version: changed rows in place of those under their keys, new rows added.

        One merge by bucket, in which the state is not shuffled and each task writes one bucket. Keys
        have no NULLs, as those of the state tables do not.
        """
        rest = [c for c in state.columns if c not in self.keys]
        old = state.select(*self.keys, F.struct(*rest).alias("_old"))
        new = changes.select(*self.keys, F.struct(*rest).alias("_new"))
        both = old.join(new, self.keys, "full")
        row = F.coalesce("_new", "_old")
        return self.write(both.select(*self.keys, *[row[c].alias(c) for c in rest]), version)
