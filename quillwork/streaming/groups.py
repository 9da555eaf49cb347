"""Growing inputs: tolerant reads of new JSON lines, appends that skip known keys, and groups emitted once complete."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.funnel import decide, pending

RESULT = "path string, doc string, expected int, solvable boolean, confidence string"


def lines(spark: SparkSession, folder: str, schema: str, files: int = 1000) -> DataFrame:
    """A stream of the JSON lines of a folder's files, old and new, so many files at a time; malformed lines are skipped."""
    raw = spark.readStream.option("maxFilesPerTrigger", files).text(folder)
    return raw.filter(F.try_parse_json("value").isNotNull()).select(F.from_json("value", schema).alias("r")).select("r.*")


def append_new(stream: DataFrame, out: str, keys: list[str], checkpoint: str) -> StreamingQuery:
    """Append the rows whose keys the table at out does not have yet, all that there are now, and stop. A batch that is
    written again after a failure adds nothing."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.dropDuplicates(keys)
        jvm = spark._jvm.org.apache.hadoop.fs.Path(out)
        if jvm.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm):
            rows = pending(rows, spark.read.schema(batch.schema).parquet(out), keys)
        rows.write.mode("append").parquet(out)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def completed(results: DataFrame) -> DataFrame:
    """Batch form: (path, n, solvable, confidence) of the paths of which all expected documents have a result.

    results: path, doc, expected, solvable, confidence; the least doc's first result counts if a document has several.
    solvable counts documents that suffice alone; confidence is the mean for passing paths as in funnel.decide.
    """
    one = results.groupBy("path", "doc").agg(F.min(F.struct(F.coalesce("solvable", F.lit(False)).alias("solvable"), F.coalesce("confidence", F.lit("")).alias("confidence"))).alias("x"), F.max("expected").alias("expected"))
    one = one.select("path", "doc", "expected", "x.solvable", "x.confidence")
    whole = one.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.max("expected").alias("expected")).filter("n >= expected").select("path", "n")
    return whole.join(decide(one.select("path", "solvable", "confidence")), "path").select("path", "n", "decision", "confidence")


def complete_groups(stream: DataFrame) -> DataFrame:
    """Stream form: rows (path, docs, solvable, confidences) once all expected results of a path have come; each path once.

    The state of a path holds its documents' results, at most `expected` of them. A document that comes again is
    ignored, as is anything after the path is out.
    """
    state = "docs array<string>, solvable array<boolean>, confidences array<string>, expected int, sent boolean"

    def step(key: tuple, batches: Iterator[pd.DataFrame], group: GroupState) -> Iterator[pd.DataFrame]:
        docs, solvable, confidence, expected, sent = ([*x] if isinstance(x, (list, tuple)) or hasattr(x, "__len__") else x for x in group.get) if group.exists else ([], [], [], 0, False)
        for b in batches:
            for r in b.itertuples(index=False):
                expected = max(expected, int(r.expected))
                if not sent and r.doc not in docs:
                    docs.append(r.doc)
                    solvable.append(bool(r.solvable) if r.solvable is not None else False)
                    confidence.append(r.confidence or "")
        if not sent and len(docs) >= expected > 0:
            yield pd.DataFrame({"path": [key[0]], "docs": [list(docs)], "solvable": [list(solvable)], "confidences": [list(confidence)]})
            docs, solvable, confidence, sent = [], [], [], True
        group.update((docs, solvable, confidence, expected, sent))

    out = "path string, docs array<string>, solvable array<boolean>, confidences array<string>"
    return stream.groupBy("path").applyInPandasWithState(step, out, state, "append", GroupStateTimeout.NoTimeout)
