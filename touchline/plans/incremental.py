"""The batch pipeline over folders that keep growing: new files only, and only the matches they touch.

``advance`` takes up the files that came since the last call. Raw rows, match documents and rejects are file streams with checkpoints: each
load writes a partition of its own, which a repeated load replaces. A ledger names the matches of each load. Downstream stages work match by match, so
bronze, silver and gold are built anew for the matches of loads that are not yet published, and replace just their partitions. A load is marked as
published after its gold is written: a call that broke off is made up for by the next one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import schemas
from touchline.operators.kept import keep, released
from touchline.plans import bronze, gold, raw, silver
from touchline.sources import files, quarantine
from touchline.sources import match_info as info_source
from touchline.sources.sinks import write_by_match

def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


LEDGER, PUBLISHED, REJECTS = _texts("load", "match_id"), _texts("load"), _texts(*quarantine.REJECT_COLUMNS)


@dataclass(frozen=True)
class Growing:
    """Where new files come, and the root of the tables."""

    records: str
    documents: str
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


def _put(rows: DataFrame, path: str, load: str, *more: str) -> None:
    """Writes one load; doing it again replaces what it wrote before."""
    rows.write.mode("overwrite").partitionBy(*more).parquet(f"{path}/load={load}")


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table of loads; empty before its first load."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def _take(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def take_up(spark: SparkSession, growing: Growing) -> None:
    """New records and documents into the raw tables, the quarantine and the ledger."""

    def records(lines: DataFrame, batch: int) -> None:
        with released():
            split, load = quarantine.time_major(keep(lines)), f"records-{batch}"
            rows = raw.raw_positions(split.good)
            _put(rows, growing.path("raw_positions"), load, "match_id")
            _put(split.rejects, growing.path("rejects"), load)
            _put(rows.select("match_id").distinct(), growing.path("ledger"), load)

    def documents(texts: DataFrame, batch: int) -> None:
        with released():
            split, load = quarantine.match_documents(keep(texts)), f"documents-{batch}"
            info = info_source.match_info(split.good)
            _put(info, growing.path("match_info"), load)
            _put(split.rejects, growing.path("rejects"), load)
            _put(info.select("match_id").distinct(), growing.path("ledger"), load)

    _take(quarantine.text_lines(spark, growing.records, streaming=True), records, growing.path("checkpoints/records"))
    _take(quarantine.text_lines(spark, growing.documents, streaming=True, whole=True), documents, growing.path("checkpoints/documents"))


def _of(table: DataFrame, changed: DataFrame) -> DataFrame:
    """The partitions of the changed matches; the join prunes them at run time."""
    return table.join(changed, "match_id", "left_semi")


@released()
def publish(spark: SparkSession, growing: Growing) -> bool:
    """Builds all stages anew for the matches of unpublished loads; tells whether there were any."""
    ledger = _stored(spark, growing.path("ledger"), LEDGER)
    done = _stored(spark, growing.path("published"), PUBLISHED)
    waiting = keep(ledger.join(done, "load", "left_anti"))
    changed = keep(waiting.filter(F.col("match_id").isNotNull()).select("match_id").distinct())
    if changed.isEmpty():
        return False
    raw_rows = _of(_stored(spark, growing.path("raw_positions"), schemas.RAW_POSITIONS), changed)
    info = info_source.one_per_match(_stored(spark, growing.path("match_info"), schemas.MATCH_INFO))
    only = {"partitionOverwriteMode": "dynamic"}
    write_by_match(bronze.bronze_positions(raw_rows, info), growing.path("bronze_positions"), options=only)
    rows = _of(files.stage_table(spark, growing.path("bronze_positions"), schemas.BRONZE_POSITIONS), changed)
    write_by_match(silver.silver_positions(rows), growing.path("silver_positions"), options=only)
    rows = _of(files.stage_table(spark, growing.path("silver_positions"), schemas.SILVER_POSITIONS), changed)
    write_by_match(gold.gold_possessions(rows), growing.path("gold_possessions"), frame="possession_id", options=only)
    waiting.select("load").distinct().write.mode("append").parquet(growing.path("published"))
    return True


def advance(spark: SparkSession, growing: Growing) -> bool:
    """Takes up what has come and publishes the matches it touches."""
    take_up(spark, growing)
    return publish(spark, growing)


def rejects(spark: SparkSession, growing: Growing) -> DataFrame:
    """The quarantine: what no load could read."""
    return _stored(spark, growing.path("rejects"), REJECTS)
