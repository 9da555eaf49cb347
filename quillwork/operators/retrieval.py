"""BM25, mixes of distractors, and retrieval measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..sources.scratch import maybe_broadcast, partitions, stash


def term_counts(docs: DataFrame) -> DataFrame:
    """(doc, term, tf, dl)."""
    t = docs.select("doc", tx.tokens(F.col("text")).alias("w")).select("doc", F.size("w").alias("dl"), F.explode("w").alias("term"))
    return t.groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf"), F.first("dl").alias("dl"))


def term_weights(counts: DataFrame, n_docs: int) -> DataFrame:
    df = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return df.withColumn("idf", F.log((n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1))


def bm25(docs: DataFrame, queries: DataFrame, k: int, k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """(query, doc, score, rank): the k best; ties to the smaller doc; documents without a term of the query are not returned.

    Only tokens that are terms of queries are shuffled, dealt by document, so that scores are summed and each task's best
    chosen where they are. queries: query, text. Null and empty texts have no terms; they count in the mean length.
    """
    spark = docs.sparkSession
    sizes = docs.select(F.size(tx.tokens(F.col("text"))).alias("dl")).agg(F.avg("dl").alias("m"), F.count(F.lit(1)).alias("n")).first()
    mean = sizes["m"] or 1.0
    q = stash(queries.select("query", F.explode(tx.tokens(F.col("text"))).alias("term")).groupBy("query", "term").agg(F.count(F.lit(1)).alias("qf")), "query-terms")
    terms = maybe_broadcast(q.select("term").distinct(), 500_000, F.octet_length("term"))
    t = docs.select("doc", tx.tokens(F.col("text")).alias("w")).select("doc", F.size("w").alias("dl"), F.explode("w").alias("term"))
    t = t.join(terms, "term", "left_semi").repartition(partitions(spark), "doc")
    counts = stash(t.groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf"), F.first("dl").alias("dl")), "postings")
    idf = term_weights(counts, sizes["n"]).select("term", "idf")
    want = q.join(idf, "term")
    impact = F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / mean))
    hit = counts.repartition(partitions(spark), "doc").join(maybe_broadcast(want, 500_000, F.octet_length("term")), "term")
    s = hit.groupBy("query", "doc").agg(F.round(F.sum(impact * F.col("qf")), 6).alias("score"))
    return ranked(s, k)


def ranked(s: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query").orderBy(F.col("score").desc(), "doc")
    return s.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def measures(hits: DataFrame, gold: DataFrame) -> DataFrame:
    """One row: n, mrr, recall over all queries that have gold, and g3_recall over those with gold of grade 3.

    hits: query, doc, rank; gold: query, doc, and grade where there is one (2 otherwise; below 2 is no gold). Means over
    nothing are 0. Repeated gold rows count once.
    """
    grade = F.col("grade") if "grade" in gold.columns else F.lit(2)
    g = gold.select("query", "doc", grade.alias("grade")).groupBy("query", "doc").agg(F.max("grade").alias("grade")).filter("grade >= 2")
    found = g.join(hits, ["query", "doc"], "left")
    top = F.col("grade") >= 3
    per = found.groupBy("query").agg(
        F.coalesce(F.max(1 / F.col("rank")), F.lit(0.0)).alias("rr"),
        (F.count("rank") / F.count(F.lit(1))).alias("recall"),
        (F.count(F.when(top, F.col("rank"))) / F.nullif(F.count_if(top), F.lit(0))).alias("g3"),
    )
    mean = lambda c: F.round(F.coalesce(F.avg(c), F.lit(0.0)), 6)
    return per.agg(F.count(F.lit(1)).alias("n"), mean("rr").alias("mrr"), mean("recall").alias("recall"), mean("g3").alias("g3_recall"))


def distractors(dense: DataFrame, lexical: DataFrame, gold: DataFrame, dense_k: int = 2, lexical_k: int = 1, most: int = 3) -> DataFrame:
    """(query, doc, source, place): documents that are no gold, the dense ones first, then lexical ones not chosen yet.

    dense: (query, doc, score), gold is taken out before it is ranked; lexical: (query, doc, rank), of which the first
    dense_k + lexical_k + 4 are looked at, gold included.
    """
    keys = gold.select("query", "doc").distinct()
    first = ranked(dense.join(keys, ["query", "doc"], "left_anti"), dense_k).select("query", "doc", F.lit("embedding").alias("source"), F.col("rank").alias("place"))
    pool = lexical.filter(F.col("rank") <= dense_k + lexical_k + 4).join(keys, ["query", "doc"], "left_anti").join(first.select("query", "doc"), ["query", "doc"], "left_anti")
    w = Window.partitionBy("query").orderBy("rank")
    then = pool.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= lexical_k).select("query", "doc", F.lit("bm25").alias("source"), F.col("place") + dense_k)
    both = first.union(then)
    order = Window.partitionBy("query").orderBy("place")
    return both.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)
