"""Per-batch result tables and the start of a streaming query.

A batch owns the folder ``batch_id=<n>`` and overwrites it, so that a replayed
batch leaves one result, not two.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def _folder(table: str, batch_id: int) -> str:
    return f"{table}/batch_id={batch_id}"


def in_layout(df: DataFrame, schema: str, **known: object) -> DataFrame:
    """The columns of ``schema`` from ``df`` and from ``known`` values; null where there is neither."""
    have = {**{c: F.col(c) for c in df.columns}, **{c: F.lit(v) for c, v in known.items()}}
    fields = T.StructType.fromDDL(schema).fields
    return df.select(*(have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields))


def write_batch(rows: DataFrame, table: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(_folder(table, batch_id))


def read_batch(spark: SparkSession, table: str, batch_id: int, schema: str) -> DataFrame:
    """The rows of one batch, without listing the others."""
    return spark.read.schema(schema).parquet(_folder(table, batch_id))


def has_batch(spark: SparkSession, table: str, batch_id: int) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(_folder(table, batch_id))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def read_batches(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """All rows so far, with their ``batch_id``."""
    rows = spark.read.schema(f"batch_id BIGINT, {schema}").parquet(table)
    return rows.select("batch_id", *(c for c in rows.columns if c != "batch_id"))


def batch_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``batch_id, path`` of every file that a query over a folder has been given, from the log in its checkpoint.

    The log lists a file with the batch that read it first; a replayed batch reads the same files.
    """
    lines = spark.read.text(f"{checkpoint}/sources/0").where(F.col("value").startswith("{"))
    entry = F.from_json("value", "path STRING, batchId BIGINT")
    return lines.select(entry.alias("entry")).select(F.col("entry.batchId").alias("batch_id"), "entry.path").distinct()


def start(
    writer: DataStreamWriter, checkpoint: str, every: str | None = None, available_now: bool = False
) -> StreamingQuery:
    """Start in append mode with a checkpoint, every so often or once over what is there."""
    trigger = {"availableNow": True} if available_now else {"processingTime": every or "0 seconds"}
    return (
        writer.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def run(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Wait until the query ends (True) or ``timeout`` seconds pass (False)."""
    if timeout is None:
        query.awaitTermination()
        return True
    return bool(query.awaitTermination(timeout))
