"""Incremental ingest of result files: each file is parsed once, and the rows of a batch become visible together, once.

Rows, rejects and the files they came from go to one table log in one entry, so a batch that broke off anywhere has added nothing, and one that runs
again, even without the checkpoint, adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.sinks.tablelog import TableLog
from tessera.sources.readers import FileFormat, file_of, format_of

Parse = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


def ingest(spark: SparkSession, source: str, parse: Parse | FileFormat, root: str, checkpoint: str, rows: str = "rows", rejects: str = "rejects") -> StreamingQuery:
    """Parse what has landed under `source` since the last run into the tables `rows` and `rejects` of the log at `root`, and stop.

    parse: frames of (file, start, value) -> (rows, rejects), both with `file`; of lines, or whole texts for a format that says so. One file is one data object. Checkpoint and root are shared folders."""
    kind = parse if isinstance(parse, FileFormat) else FileFormat(parse)
    text = spark.readStream.text(source, wholetext=kind.whole)
    values = text.select(file_of().alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    log = TableLog(spark, root)

    def load(batch: DataFrame, number: int) -> None:
        good, bad = kind.parse(batch)
        log.append_new({rows: good, rejects: bad}, "file", f"{checkpoint}:{rows}", number)

    return values.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_types(spark: SparkSession, sources: dict[str, str], root: str, checkpoint: str, table: Callable[[str], str]) -> dict[str, StreamingQuery]:
    """One stream for each file type, all into one log. sources: type -> folder; table: type -> name of its table (rejects go to `<name>_rejects`)."""
    formats = {kind: format_of(kind) for kind in sources}
    return {kind: ingest(spark, source, formats[kind], root, f"{checkpoint}/{table(kind)}", table(kind), f"{table(kind)}_rejects") for kind, source in sources.items()}
