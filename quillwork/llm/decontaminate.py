"""Benchmark decontamination: size-partitioned MinHash containment search, in native expressions only.

Items are partitioned by the number of their shingles, and each partition has its own sketch length. An item's sketch
is its k least shingle hashes, with k one more than the shingles that a text may lack at the threshold; so a text with
enough of the item's shingles has at least one of the sketch, and the search loses nothing. The sketches make up the
index; every shingle of every text is looked up in it. Candidates are confirmed on the whole shingle sets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, carried, gathered, let, maybe_broadcast, stash, with_rid, words


@dataclass(frozen=True)
class Settings:
    """A text leaks an item if 100 * shared shingles >= percent * shingles of the item."""

    shingle: int = 5
    percent: int = 75
    partitions: tuple[int, ...] = (8, 16, 32, 64, 128, 256, 512, 1024)  # upper sizes; larger items form a last one
    broadcast_rows: int = 200_000


def shingle_hashes(text: Column, k: int) -> Column:
    """Hashes of all k-word shingles, in place order; a text with fewer words is one shingle, one without words none."""

    def of(w: Column) -> Column:
        n = F.size(w)
        return F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))).when(n > 0, F.array(F.xxhash64(F.array_join(w, " "), F.lit(k)))).otherwise(F.array().cast("array<bigint>"))

    return let(words(ascii_lower(text)), of)


def shingle_texts(text: Column, k: int) -> Column:
    """The shingles themselves, distinct."""

    def of(w: Column) -> Column:
        n = F.size(w)
        return F.when(n >= k, F.array_distinct(F.transform(F.sequence(F.lit(0), n - k), lambda i: F.concat_ws(" ", *[F.get(w, i + j) for j in range(k)])))).when(n > 0, F.array(F.array_join(w, " "))).otherwise(F.array().cast("array<string>"))

    return let(words(ascii_lower(text)), of)


def sketches(items: DataFrame, s: Settings) -> DataFrame:
    """(hash, item, n, least): the index. least: the fewest shingles that a text must have."""
    h = items.select(F.col("item_id").alias("item"), F.sort_array(F.array_distinct(shingle_hashes(F.col("text"), s.shingle))).alias("h")).withColumn("n", F.size("h"))
    part = F.lit(None).cast("int")
    for top in reversed(s.partitions):
        part = F.when(F.col("n") <= top, F.lit(top)).otherwise(part)
    size = F.coalesce(part, F.col("n"))  # the partition's upper size; each of the largest items is its own
    lack = F.floor(size * (100 - s.percent) / 100).cast("int")
    h = h.filter("n > 0").withColumn("sketch", F.slice("h", 1, F.least(F.col("n"), lack + 1)))
    return h.select("item", "n", F.explode("sketch").alias("hash")).withColumn("least", F.ceil(F.col("n") * s.percent / 100).cast("int"))


def leaks(docs: DataFrame, items: DataFrame, s: Settings = Settings(), numbered: bool = False) -> DataFrame:
    """Pairs (_rid, doc_id, item_id, n_item, n_shared, containment) of texts and items that they hold.

    Items are compared by their distinct shingles; null or wordless items and texts hold nothing and match nothing.
    Repeated doc_ids: a pair for each row; repeated item rows with equal text: one pair for each item_id. Empty tables
    give an empty result. Only doc_id, item_id and text are read. A frequent passage costs one row for each text.
    numbered: docs has its _rid from with_rid already; a second numbering of repeated ids may differ from the first.
    """
    docs = docs.select("_rid", "doc_id", "text") if numbered else with_rid(docs.select("doc_id", "text"))
    items = items.select("item_id", "text").distinct().withColumn("item_id", F.struct("item_id", F.xxhash64("text").alias("v")))
    index = stash(sketches(items, s), "index")
    h = docs.select("_rid", shingle_hashes(F.col("text"), s.shingle).alias("h"))
    probe = h.select("_rid", F.size("h").alias("size"), F.explode("h").alias("hash"))
    hit = probe.join(maybe_broadcast(index, s.broadcast_rows), "hash").filter("size >= least").select("_rid", "item").distinct()
    pairs = stash(hit, "pairs")
    ids = pairs.select("_rid").distinct()
    wanted = docs.join(maybe_broadcast(ids, s.broadcast_rows), "_rid", "left_semi").select("_rid", "doc_id", shingle_texts(F.col("text"), s.shingle).alias("d"))
    sets = items.select(F.col("item_id").alias("item"), shingle_texts(F.col("text"), s.shingle).alias("q"))
    full = pairs.join(maybe_broadcast(sets, s.broadcast_rows // 50, F.aggregate("q", F.lit(0), lambda t, x: t + F.octet_length(x))), "item").join(wanted, "_rid")
    shared = F.size(F.array_intersect("q", "d"))
    full = full.select("_rid", "doc_id", F.col("item.item_id").alias("item_id"), F.size("q").alias("n_item"), shared.alias("n_shared"))
    full = full.filter(100 * F.col("n_shared") >= s.percent * F.col("n_item"))
    return full.groupBy("_rid", "doc_id", "item_id").agg(F.max(F.struct(F.col("n_shared") / F.col("n_item"), "n_item", "n_shared")).alias("m")).select("_rid", "doc_id", "item_id", F.col("m.n_item").cast("long").alias("n_item"), F.col("m.n_shared").cast("long").alias("n_shared"), F.round(F.col("m.n_shared") / F.col("m.n_item"), 6).alias("containment"))


def query(spark, sf_dir: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("_rid")


#: DuckDB: brute force over all shingles, for the query.
SQL = r"""
with d as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') as w from documents),
b as (select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') as w from benchmark),
ds as (select distinct doc_id, s from (select doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from d)),
bs as (select distinct item_id, s from (select item_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from b)),
n as (select item_id, count(*) as n_item from bs group by item_id)
select doc_id, item_id, cast(n_item as bigint) as n_item, cast(count(*) as bigint) as n_shared, round(count(*) / n_item, 6) as containment
from ds join bs using (s) join n using (item_id) group by doc_id, item_id, n_item having 100 * count(*) >= 75 * n_item
"""


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go; the others stay with all their columns, of any name.

    Null and wordless texts hold nothing and stay. Repeated or null doc_ids: each row is a document of its own, numbered
    once. Empty tables: an empty result without documents, all documents without items.
    """
    named = with_rid(carried(docs, "doc_id", "text"))
    found = leaks(named, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), numbered=True).select("_rid").distinct()
    return gathered(named.join(found, "_rid", "left_anti").select("_row.*"))
