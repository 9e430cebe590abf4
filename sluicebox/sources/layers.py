"""Readers of the stored layers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluicebox.schemas import BRONZE_SCHEMA, FAITHFUL_CSV, SILVER_COLUMNS, SILVER_SCHEMA, TEXT_TIMES
from sluicebox.sources.batches import read_batches


class LayerNotReady(RuntimeError):
    """A layer that a report cannot do without is not there yet."""

    def __init__(self, layer: str, path: str):
        super().__init__(f"the {layer} layer is not readable at {path}; has its job run?")
        self.layer = layer
        self.path = path


def read_bronze(
    spark: SparkSession, path: str, recursive: bool = True, schema: StructType | None = BRONZE_SCHEMA
) -> DataFrame:
    """Bronze rows, by default from any subfolder. ``schema=None`` takes the schema of a file footer."""
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver rows in layer order.

    With the schema given, partition values such as an all-numeric bank id stay text, whatever the
    session's inference setting is. Of batch folders that were compacted, each row counts once.
    """

    def read(more: str) -> DataFrame:
        return spark.read.schema(_with_folders(more)).parquet(path)

    return read_batches(spark, path, read).select(*SILVER_COLUMNS)


def _with_folders(more: str) -> StructType:
    return StructType(SILVER_SCHEMA.fields + (StructType.fromDDL(more).fields if more else []))


def read_garbage(spark: SparkSession, path: str) -> DataFrame:
    """Rejected rows. JSON leaves null fields out, so the schema is given rather than inferred."""


    def read(more: str) -> DataFrame:
        return spark.read.schema(_with_folders(more)).options(**TEXT_TIMES).json(path)

    return read_batches(spark, path, read).select(*SILVER_COLUMNS)


def read_csv_rows(spark: SparkSession, path: str) -> DataFrame:
    """Silver rows of a CSV export. Nothing between commas is null, a pair of quotes is the empty text."""
    no_text = "\u0001"  # what an absent value is called inside the reader; it only has to differ from the empty text
    return spark.read.schema(SILVER_SCHEMA).options(**FAITHFUL_CSV, nullValue=no_text, emptyValue="").csv(path)


def _latest_runs(rows: DataFrame) -> DataFrame:
    """Of each file name the rows of the last run that wrote it: a file processed again replaces itself and no other."""
    file = ["bank_dir", "channel_dir", "file_name"]
    latest = rows.groupBy(*file).agg(F.max("run").alias("run"))
    return rows.join(latest, [*file, "run"], "left_semi").drop("run")


def read_flat_silver(spark: SparkSession, path: str) -> DataFrame:
    """Accepted flat events: folders, file name, and the five members of each document."""
    schema = (
        "run STRING, bank_dir STRING, channel_dir STRING, file_name STRING, event STRUCT<transaction_id: STRING,"
        " amount: VARIANT, timestamp: STRING, bank_id: STRING, channel: STRING>"
    )
    rows = _latest_runs(spark.read.schema(schema).json(path))
    return rows.select("bank_dir", "channel_dir", "file_name", "event.*")


def read_flat_garbage(spark: SparkSession, path: str) -> DataFrame:
    """Rejected flat events: folders, issue, file name, and the unchanged text."""
    schema = "run STRING, bank_dir STRING, channel_dir STRING, issue STRING, file_name STRING, event_text STRING"
    return _latest_runs(spark.read.schema(schema).json(path))


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty frame that Catalyst knows to be empty."""
    return spark.range(0).select(*[F.lit(None).cast(field.dataType).alias(field.name) for field in schema])


def read_garbage_if_any(spark: SparkSession, path: str) -> DataFrame:
    """Rejected rows, or an empty frame of the same schema while nothing was ever rejected."""
    try:
        return read_garbage(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return no_rows(spark, SILVER_SCHEMA)


def read_required(spark: SparkSession, bronze_path: str, silver_path: str) -> tuple[DataFrame, DataFrame]:
    """Bronze and silver for a report, or :class:`LayerNotReady` naming the one that is missing or has no file."""
    frames = []
    for layer, path in (("bronze", bronze_path), ("silver", silver_path)):
        try:
            frame = read_bronze(spark, path) if layer == "bronze" else read_silver(spark, path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            raise LayerNotReady(layer, path) from error
        if not frame.inputFiles():
            raise LayerNotReady(layer, path)
        frames.append(frame)
    return frames[0], frames[1]
