"""Shared helpers: scratch storage on the shared folder, row ids, worker set-up, text buffers."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import gathered, listed, maybe_broadcast, partitions, release, scratch, small_enough, stash

__all__ = ["gathered", "listed", "maybe_broadcast", "partitions", "release", "scratch", "small_enough", "stash"]

ROOT = str(Path(__file__).resolve().parents[2])
#: ASCII white space of the word pattern [^\x20\x09-\x0D]+.
WHITE = " \t\n\x0b\x0c\r"
NOT_WORD = r"[ \t\n\x0B\f\r]+"

def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package, and bound the bytes of an Arrow batch."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)
    env.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")  # workers are used again; other pools keep what a batch took
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")


def share(rows: int, spark: SparkSession) -> int:
    """Rows of one key above which a join deals them over several tasks; so there are at most 4 * partitions such keys."""
    return max(2000, rows // (4 * partitions(spark)))


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], counts: DataFrame, most: int, how: str = "inner") -> DataFrame:
    """left joined with right on keys; the left rows of a key that has more than `most` are dealt over several tasks,
    each of which gets the key's right rows. counts: (keys, _n), the number of left rows, or more, of such keys at least.
    """
    hot = F.broadcast(counts.filter(F.col("_n") > most).select(*keys, F.ceil(F.col("_n") / most).cast("int").alias("_parts")))
    part = F.when(F.col("_parts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*left.columns), F.col("_parts")).cast("int"))
    a = left.join(hot, keys, "left").withColumn("_part", part).drop("_parts")
    b = right.join(hot, keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return a.join(b, [*keys, "_part"], how).drop("_part")


def let(value: Column, body) -> Column:
    """Evaluate value once for each row and hand it to body, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ of a text; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, NOT_WORD))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def remainder(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, mod m; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % m


def carried(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns, and all columns as one, _row: what operators add then clashes with no column of the input."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *names)


def with_rid(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Add _rid, a unique long that rises with the key. It is the key itself unless keys repeat or are null.

    Repeated or null keys: every row is a document of its own; rows go by key (nulls first), then text. Equal rows are
    dealt over several tasks. A second call may number such rows otherwise: call it once and hand the frame on.
    """
    dirty = docs.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or k is null")
    if dirty.limit(1).count() == 0:
        return docs.withColumn("_rid", F.col(key).cast("long"))
    scanned = docs.withColumn("_tie", F.monotonically_increasing_id())
    order = [F.col(key).asc_nulls_first(), F.col(text).asc_nulls_first(), F.col("_tie")]
    ranged = scanned.repartitionByRange(F.col(key).asc_nulls_first(), F.substring(text, 1, 64).asc_nulls_first(), F.col("_tie")).sortWithinPartitions(*order)
    return stash(ranged.withColumn("_rid", F.monotonically_increasing_id()).drop("_tie"), "rid")


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, nulls as empty; zero copy where Arrow allows."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if not pa.types.is_binary(col.type) and not pa.types.is_large_binary(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    d = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return d[o[0] : o[-1]], o - o[0]


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a slice have at most limit bytes, one row at least."""
    _, o = buffers(batch.column(column))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(o, o[i] + limit, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (public splitmix constants), element by element."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def string_hashes(col: pa.Array) -> np.ndarray:
    """64-bit hash of each string of a (small) column."""
    import xxhash

    f = xxhash.xxh3_64_intdigest
    return np.fromiter((f(x) for x in col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()), np.uint64, len(col))


class Known:
    """Ids of the words that a worker has met, in arrays: a word's ids are flat[first : first + size]."""

    def __init__(self, most: int):
        self.most = most  # words, and 32 times as many bytes; beyond it, the memory starts anew
        self.clear()

    def clear(self) -> None:
        self.words = pa.array([], pa.string())
        self.first, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def find(self, names: pa.Array) -> np.ndarray:
        """Index of each name, -1 for a new one."""
        return np.asarray(pc.index_in(names, value_set=self.words).fill_null(-1), dtype=np.int64)

    def ids(self, names: pa.Array, encode) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first, size, flat) of distinct names; encode(new names) gives (size, flat) of those not met before."""
        if len(self.words) > self.most or self.words.nbytes > 32 * self.most:
            self.clear()
        at = self.find(names)
        new = names.filter(pa.array(at < 0))
        if len(new):
            size, flat = encode(new)
            self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(size) - size])
            self.size, self.flat = np.concatenate([self.size, size]), np.concatenate([self.flat, flat.astype(np.uint32)])
            at[at < 0] = np.arange(len(self.words), len(self.words) + len(new))
            self.words = pa.concat_arrays([self.words, new])
        return self.first[at], self.size[at], self.flat
