"""Schemas and tables of the analytics warehouse: replaced as a whole, or appended to file by file."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from patronlens.contract import RAW_TABLES
from patronlens.shared import exists
from patronlens.sources.csv_files import read_csv
from patronlens.streaming.jobs import ingest_new_files

# The four schemas.
SCHEMAS = ["raw_data", "transformed", "features", "ml_models"]


@dataclass(frozen=True)
class Warehouse:
    """Tables named ``<prefix><schema>.<table>``.

    ``location`` puts every schema below one shared folder; without it the session's warehouse folder is used.
    """

    spark: SparkSession
    prefix: str = ""
    location: str | None = None

    def name(self, schema: str, table: str) -> str:
        return f"{self.prefix}{schema}.{table}"

    def create(self) -> Warehouse:
        for schema in SCHEMAS:
            where = f" LOCATION '{self.location}/{schema}'" if self.location else ""
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.prefix}{schema}{where}")
        return self

    def drop(self) -> None:
        """Drop the schemas with all they hold."""
        for schema in SCHEMAS:
            self.spark.sql(f"DROP SCHEMA IF EXISTS {self.prefix}{schema} CASCADE")

    def table(self, schema: str, table: str) -> DataFrame:
        return self.spark.table(self.name(schema, table))

    def save(self, df: DataFrame, schema: str, table: str) -> DataFrame:
        """Replace a table and return it read back, so that whatever follows sees what was stored."""
        df.write.mode("overwrite").saveAsTable(self.name(schema, table))
        return self.table(schema, table)

    def create_raw_tables(self) -> None:
        """Replace the three raw tables by empty ones of the declared layout."""
        for table, layout in RAW_TABLES.items():
            self.save(self.spark.createDataFrame([], layout), "raw_data", table)

    def load_csv(self, table: str, path: str | list[str]) -> DataFrame:
        """Bulk load one raw table from CSV."""
        return self.save(read_csv(self.spark, path, RAW_TABLES[table]), "raw_data", table)

    def folder(self, schema: str) -> str:
        return self.spark.catalog.getDatabase(f"{self.prefix}{schema}").locationUri

    def appended(self, table: str) -> str | None:
        """The Parquet folder of a raw table that is appended to; None if it was loaded as a whole or never."""
        name = self.name("raw_data", table)
        if not self.spark.catalog.tableExists(name) or self.spark.catalog.getTable(name).tableType != "VIEW":
            return None
        return f"{self.folder('raw_data')}/_ingested/{table}"

    def append_csv(self, table: str, landing: str) -> DataFrame:
        """Add the files of a landing folder that no run has loaded yet; each is loaded once, also after a failure.

        The raw table is then a view of the rows ingested so far, none if no file ever came. A table that was loaded as a
        whole stays one.
        """
        name = self.name("raw_data", table)
        if self.spark.catalog.tableExists(name) and self.appended(table) is None:
            raise ValueError(f"{name} was loaded as a whole; drop it before appending")
        rows = f"{self.folder('raw_data')}/_ingested/{table}"
        ingest_new_files(self.spark, landing, RAW_TABLES[table], rows, f"{rows}_progress")
        if exists(self.spark, f"{rows}/_spark_metadata/0"):  # a first batch was written
            query = f"SELECT {', '.join(RAW_TABLES[table].names)} FROM parquet.`{rows}`"
        else:
            columns = [f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in RAW_TABLES[table]]
            query = f"SELECT {', '.join(columns)} WHERE false"
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
        return self.table("raw_data", table)


def lower_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])
