"""Incremental indexing with Structured Streaming.

In the reference a document is searchable as soon as it is inserted because
the lexeme column is generated on write.  Here new JSONL documents arriving
in a folder are indexed micro-batch by micro-batch: ``foreachBatch`` writes
the batch's corpus rows, postings and vectors under ``batch_id=<n>``.  A
replayed batch overwrites its own partition (dynamic partition overwrite),
so the sink is idempotent and the index equals the batch index of the same
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.analyze import postings
from ..operators.embedding import embed_corpus

DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType(), False),
    T.StructField("title", T.StringType(), True),
    T.StructField("body", T.StringType(), True),
    T.StructField("tags", T.ArrayType(T.StringType()), True),
])


def _index_batch(out_dir: str, dims: int):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        corpus = batch.select("doc_id", F.coalesce("title", F.lit("")).alias("title"),
                              F.coalesce("body", F.lit("")).alias("body"),
                              F.coalesce("tags", F.array().cast("array<string>")).alias("tags"))
        tables = {"corpus": corpus, "postings": postings(corpus), "vectors": embed_corpus(corpus, dims)}
        for name, df in tables.items():
            (df.withColumn("batch_id", F.lit(batch_id).cast("long"))
             .write.mode("overwrite").partitionBy("batch_id").parquet(f"{out_dir}/{name}"))
    return run


def start_index_stream(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str,
                       dims: int = 128, files_per_trigger: int = 1, available_now: bool = True):
    """Start the stream; returns the ``StreamingQuery``."""
    stream = (spark.readStream.schema(DOC_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
              .json(source_dir))
    w = (stream.writeStream.foreachBatch(_index_batch(out_dir, dims))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def read_index(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{out_dir}/{n}") for n in ("corpus", "postings", "vectors")}
