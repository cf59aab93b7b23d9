"""One micro-batch through all levels: bronze, silver, grouped and gold."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from touchline import schemas
from touchline.operators import quality
from touchline.operators.kept import keep, released
from touchline.plans import bronze, grouped, raw, silver
from touchline.sources import constants, sinks

LEVELS = ("bronze", "silver", "grouped", "gold")
COLUMNS = {
    "bronze": schemas.BRONZE_STREAM_COLUMNS,
    "silver": schemas.SILVER_STREAM_COLUMNS,
    "grouped": schemas.GROUPED_COLUMNS,
    "gold": schemas.GOLD_STREAM_COLUMNS,
}
# A publisher gets the level, its rows and the batch id, and writes them once.
Publisher = Callable[[str, DataFrame, int], None]


class Tables:
    """Parquet per level and batch under a root; a repeated batch replaces its own output.

    ``completed`` enters a batch in the ledger once all its levels are written. ``read`` gives the rows of ledgered batches only, so a stream that was
    killed between two levels and started anew neither loses nor repeats rows, and a reader never sees half a batch.
    """

    def __init__(self, root: str):
        self.root = root

    def __call__(self, level: str, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{level}/batch={batch_id}")

    def completed(self, spark: SparkSession, batch_id: int, counts: dict[str, int]) -> None:
        # The counts come from the batch's own plans; there is one for each level.
        entry = [(level, rows) for level, rows in counts.items()]
        self("ledger", spark.createDataFrame(entry, "level string, rows bigint"), batch_id)

    def ledger(self, spark: SparkSession) -> DataFrame:
        """``level, rows, batch`` of every completed batch."""
        return spark.read.parquet(f"{self.root}/ledger")

    def read(self, spark: SparkSession, level: str) -> DataFrame:
        done = self.ledger(spark).select("batch").distinct()
        return spark.read.parquet(f"{self.root}/{level}").join(done, "batch", "left_semi")


def to_tables(root: str) -> Tables:
    return Tables(root)


def to_kafka(servers: str, topics: dict[str, str]) -> Publisher:
    def publish(level: str, rows: DataFrame, batch_id: int) -> None:
        sinks.write_kafka(sinks.as_messages(rows, list(COLUMNS[level])), servers, topics[level])

    return publish


def dry_run(level: str, rows: DataFrame, batch_id: int) -> None:
    """Computes the level without writing it anywhere."""
    rows.write.format("noop").mode("overwrite").save()


@dataclass
class LevelPipeline:
    """Settings of the stateless stream; ``counts`` holds the rows per level of the last batch.

    A level that is switched off is still computed where a later one needs it. In ``strict`` mode a match without metadata fails the batch
    from within its own plan; ``audit`` lists such matches and goes on.
    """

    info: DataFrame
    publish: Publisher = dry_run
    build: tuple[str, ...] = LEVELS
    emit: tuple[str, ...] = LEVELS
    topic: str | None = None
    offside_index: int = constants.OFFSIDE_LINE_INDEX
    strict: bool = False
    audit: bool = False
    counts: dict[str, int] = field(default_factory=dict)

    def _emit(self, level: str, rows: DataFrame, batch_id: int) -> None:
        if level not in self.build:
            return
        counted = Observation()
        rows = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
        (self.publish if level in self.emit else dry_run)(level, rows, batch_id)
        self.counts[level] = counted.get["rows"]

    def process(self, messages: DataFrame, batch_id: int) -> None:
        with released():
            self._process(messages, batch_id)
        if isinstance(self.publish, Tables):
            self.publish.completed(messages.sparkSession, batch_id, self.counts)

    def _process(self, messages: DataFrame, batch_id: int) -> None:
        self.counts = {}
        rows = raw.message_positions(messages, self.topic)
        # Checked before they are kept: else a task reads all its rows before it fails at the first.
        rows = keep(quality.checked_matches(rows, self.info) if self.strict else rows)
        bronze_rows = keep(bronze.bronze_stream_positions(rows, self.info))
        if self.audit:
            self.publish("audit", quality.unresolved_directions(bronze_rows), batch_id)
            self.publish("unknown_matches", quality.unknown_matches(rows, self.info), batch_id)
        self._emit("bronze", bronze_rows.drop("_arrival_ms"), batch_id)
        if not {"silver", "grouped", "gold"} & set(self.build):
            # Silver counts the rows of all frames before it is built.
            return
        # Silver feeds up to three outputs; it is computed once.
        silver_rows = keep(silver.silver_positions(bronze_rows, silver.STREAM, batch_id=batch_id))
        self._emit("silver", silver_rows, batch_id)
        if "grouped" in self.build or "gold" in self.build:
            teams = keep(grouped.grouped_positions(silver_rows, self.offside_index))
            self._emit("grouped", teams, batch_id)
            self._emit("gold", grouped.gold_stream_possessions(teams, batch_id), batch_id)


def start(
    messages: DataFrame,
    pipeline: LevelPipeline,
    checkpoint: str,
    interval: str | None = constants.TRIGGER_INTERVAL,
) -> StreamingQuery:
    """Starts the stream; without an interval it takes what is there and ends."""
    writer = messages.writeStream.foreachBatch(pipeline.process).option("checkpointLocation", checkpoint)
    if interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
