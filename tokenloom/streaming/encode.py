"""Encode new text files as they arrive in a folder."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import strip_blank_lines
from ..operators.bpe import Tokenizer
from ..operators.codec import encode
from ..sources.tokens import KEYWORD


def encode_new_files(spark: SparkSession, path: str, tok: Tokenizer, out: str, progress: str,
                     attr: str = "text", keyword: str = KEYWORD) -> StreamingQuery:
    """Encode the JSON-lines files that ``progress`` does not list yet, then stop.

    Encoding is row by row, so the stream holds no state; the file sink commits each batch
    once, also when a run is repeated after a failure.
    """
    lines = (
        spark.readStream.schema(f"`{attr}` string").option("mode", "FAILFAST")
        .option("pathGlobFilter", "*.jsonl*").json(path)
    )
    texts = lines.select(
        F.col("_metadata.file_name").alias("file"), strip_blank_lines(F.col(attr)).alias("text")
    )
    encoded = encode(texts, tok).select("file", F.to_json("ids").alias("value"))
    return (
        encoded.writeStream.format("text").partitionBy("file")
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start(f"{out.rstrip('/')}/{keyword}")
    )
