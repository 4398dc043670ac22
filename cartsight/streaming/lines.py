"""From a stream of lines to a stream of session fields."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartsight.functions import content_key
from cartsight.operators.features import parse_lines, typed_fields
from cartsight.schema import KEY
from cartsight.streaming.tables import start


def keyed(lines: DataFrame) -> DataFrame:
    """Give each line a key made from its text, for splits that survive a replay."""
    return lines.withColumn(KEY, content_key(F.col("value")))


def parse_stream(lines: DataFrame) -> DataFrame:
    """Key and 18 texts of every complete line."""
    return parse_lines(keyed(lines))


def parsed_sink(lines: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append the typed fields of the stream to the Parquet table at ``path``."""
    writer = typed_fields(parse_stream(lines)).writeStream.format("parquet").option("path", path)
    return start(writer, checkpoint, **trigger)
