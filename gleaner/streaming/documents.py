"""The stages that work on one document at a time, over a stream of files or rows.

Cards need no state: each micro-batch of new documents gives its own.  Counts by type
are a running aggregate.  Deduplication across documents is no stream operation; it
runs over the table that the stream writes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions import text as T


def document_stream(spark: SparkSession, folder: str, schema: str = "doc_id long, text string, lang string, source string, n_chars long", files_per_batch: int = 8) -> DataFrame:
    """New Parquet files of a folder as a stream of rows."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def sentence_cards(rows: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ("lang",)) -> DataFrame:
    """Typed, scored candidate sentences; the same for streams and tables."""
    said = rows.select(key, *keep, F.explode(F.filter(T.sentences(F.col(text)), T.is_card_sentence)).alias("claim"))
    return said.withColumn("card_type", T.card_type(F.col("claim"))).withColumn("quality", T.card_quality(F.col("claim"), F.col("card_type")))


def type_counts(cards: DataFrame) -> DataFrame:
    return cards.groupBy("lang", "card_type").agg(F.count("*").alias("n_cards"), F.round(F.sum("quality"), 2).alias("sum_quality"))


def run_once(stream: DataFrame, table: str, checkpoint: str) -> None:
    """Write what has come so far to a Parquet table, exactly once for each file, and stop."""
    stream.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
