"""The batch pipeline: from raw rows to possessions, in one plan or stage by stage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from touchline import schemas
from touchline.operators.frames import fill_down
from touchline.operators.kept import released
from touchline.plans import bronze, gold, raw, silver
from touchline.sources import files
from touchline.sources import match_info as info_source
from touchline.sources.sinks import write_by_match


def possessions_from_raw(raw_rows: DataFrame, info: DataFrame) -> DataFrame:
    """Gold straight from raw; pairing does not feed gold and is pruned from the plan."""
    known = silver.identified(bronze.bronze_positions(raw_rows, info))
    return gold.gold_possessions(fill_down(known))


@dataclass(frozen=True)
class Tables:
    """Where the stages of the batch pipeline lie."""

    root: str

    def path(self, stage: str) -> str:
        return f"{self.root}/{stage}"


def load_raw(spark: SparkSession, records: str, documents: str, tables: Tables) -> None:
    """Time-major JSON and match XML into the raw and match-info tables."""
    write_by_match(raw.raw_positions(files.time_major_records(spark, records)), tables.path("raw_positions"))
    info = info_source.one_per_match(info_source.match_info(files.match_documents(spark, documents)))
    info.write.mode("overwrite").parquet(tables.path("match_info"))


@released()
def build_bronze(spark: SparkSession, tables: Tables) -> None:
    rows = files.stage_table(spark, tables.path("raw_positions"), schemas.RAW_POSITIONS)
    info = files.stage_table(spark, tables.path("match_info"), schemas.MATCH_INFO)
    write_by_match(bronze.bronze_positions(rows, info), tables.path("bronze_positions"))


@released()
def build_silver(spark: SparkSession, tables: Tables) -> None:
    rows = files.stage_table(spark, tables.path("bronze_positions"), schemas.BRONZE_POSITIONS)
    write_by_match(silver.silver_positions(rows), tables.path("silver_positions"))


@released()
def build_gold(spark: SparkSession, tables: Tables) -> None:
    rows = files.stage_table(spark, tables.path("silver_positions"), schemas.SILVER_POSITIONS)
    write_by_match(gold.gold_possessions(rows), tables.path("gold_possessions"), frame="possession_id")


def run_batch(spark: SparkSession, records: str, documents: str, root: str) -> Tables:
    """All stages, each written and read back: later stages scan only the columns they need."""
    tables = Tables(root)
    load_raw(spark, records, documents, tables)
    build_bronze(spark, tables)
    build_silver(spark, tables)
    build_gold(spark, tables)
    return tables
