"""Selection of a corpus of linked articles: filters, rank by links into the pool and seeds, degree, projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from .similarity import first_by

#: Source, date and language of a document where the corpus gives none.
SOURCE, DATE, LANGUAGE = "linked-articles", "2017-10-01", "en"


def passes(articles: DataFrame, min_chars: int = 500, min_links: int = 3) -> DataFrame:
    """Articles of enough characters and enough links, as they stand; null ones have none."""
    return articles.filter((F.length(tx.text(F.col("article"))) >= min_chars) & (F.coalesce(F.size("links"), F.lit(0)) >= min_links))


def bounded_scan(articles: DataFrame, max_scan: int = 800_000, pool: int = 100_000, **limits) -> DataFrame:
    """The first `pool` articles that pass among the first max_scan by page_id, one for each title."""
    seen = articles.orderBy("page_id").limit(max_scan)
    return one_per_title(passes(seen, **limits)).orderBy("page_id").limit(pool)


def title_key(title: Column) -> Column:
    return F.lower(tx.strip(title))


def one_per_title(articles: DataFrame) -> DataFrame:
    """The first article of each title in any case; of those without a title one stays."""
    return first_by(articles, title_key(F.col("title")), ["page_id"])


def seed_tokens(seeds: list[str]) -> list[str]:
    """Distinct words of four letters or more of the seeds, lower case."""
    return sorted({w for s in seeds for w in s.lower().split() if len(w) >= 4})


def rank_score(articles: DataFrame, seeds: list[str], overlap_min: float = 0.5) -> DataFrame:
    """(page_id, overlap, score): twice the share of link targets that are titles of the pool, a tenth for each of the
    first 40 targets that holds a seed and three tenths for each seed in the title, .02 for each target up to 60, and 1
    where the share reaches overlap_min. Articles without a target are left out."""
    words = tx.literals(seed_tokens(seeds)) if seed_tokens(seeds) else F.array().cast("array<string>")
    t = articles.select("page_id", F.lower(tx.text(F.col("title"))).alias("title"), tx.link_targets(F.col("links")).alias("targets")).filter(F.size("targets") > 0)
    titles = articles.select(title_key(F.col("title")).alias("target")).distinct().withColumn("hit", F.lit(1))
    overlap = t.select("page_id", F.explode("targets").alias("target")).join(titles, "target", "left").groupBy("page_id").agg((F.count("hit") / F.count(F.lit(1))).alias("overlap"))
    seeded = F.size(F.filter(F.slice("targets", 1, 40), lambda x: F.exists(words, lambda w: F.contains(x, w)))) + 3 * F.size(F.filter(words, lambda w: F.contains(F.col("title"), w)))
    score = 2.0 * F.col("overlap") + 0.10 * seeded + 0.02 * F.least(F.size("targets"), F.lit(60)) + F.when(F.col("overlap") >= overlap_min, 1.0).otherwise(0.0)
    return t.join(overlap, "page_id").select("page_id", F.round("overlap", 6).alias("overlap"), F.round(score, 6).alias("score"))


def best_ranked(articles: DataFrame, ranks: DataFrame, target: int) -> DataFrame:
    """The 1.5 * target articles of the largest score, with their place in that order, pos."""
    top = ranks.orderBy(F.col("score").desc(), "page_id").limit(int(1.5 * target))
    place = F.row_number().over(Window.orderBy(F.col("score").desc(), "page_id"))  # at most 1.5 * target rows
    return articles.join(top.withColumn("pos", place).select("page_id", "pos"), "page_id")


def degrees(pool: DataFrame, least: int = 2, most: int = 400) -> DataFrame:
    """(page_id, degree): the titles of the pool that an article links to, of those that least to most articles link to.
    Namespaces count here; 0 where there is none."""
    titles = pool.select(title_key(F.col("title")).alias("target")).distinct()
    raw = F.transform(F.coalesce("links", F.array().cast("array<string>")), lambda h: tx.decoded(h))
    links = pool.select("page_id", F.explode(F.array_distinct(raw)).alias("target")).filter((F.col("target") != "") & ~F.startswith("target", F.lit("wikt:")) & ~F.contains("target", F.lit("#"))).join(titles, "target")
    known = links.groupBy("target").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n").between(least, most))
    d = links.join(known, "target").groupBy("page_id").agg(F.count(F.lit(1)).alias("degree"))
    return pool.select("page_id").join(d, "page_id", "left").select("page_id", F.coalesce("degree", F.lit(0).cast("long")).alias("degree"))


def select(pool: DataFrame, target: int) -> DataFrame:
    """The target articles of the pool (with pos) of the largest degree, then of the first places, numbered from 0: seq."""
    d = pool.join(degrees(pool), "page_id").orderBy(F.col("degree").desc(), "pos").limit(target)
    return d.withColumn("seq", F.row_number().over(Window.orderBy(F.col("degree").desc(), "pos")) - 1)  # target rows


def documents(articles: DataFrame, seq: Column) -> DataFrame:
    """Articles (page_id, title, url, article, links, and raw if there is one) as documents.

    doc_id numbers by seq; source_id is the page's own id if it is a number, else seq; a missing url is made of the id;
    links are the targets that count, repeats too; counts are of the clean text.
    """
    own = F.col("page_id").cast("string")
    body = tx.text(F.col("article"))
    return articles.select(
        F.format_string("doc_%06d", seq).alias("doc_id"), F.when(own.rlike(r"^\d+$"), F.expr("try_cast(page_id as bigint)")).otherwise(seq.cast("long")).alias("source_id"),
        F.lit(SOURCE).alias("source"), tx.text(F.col("title")).alias("title"), F.coalesce(F.nullif("url", F.lit("")), F.concat(F.lit("page:"), own)).alias("url"),
        F.lit(DATE).alias("date"), F.lit(LANGUAGE).alias("language"), (tx.text(F.col("raw")) if "raw" in articles.columns else F.lit("")).alias("raw_text"), body.alias("clean_text"),
        F.filter(F.transform(F.coalesce("links", F.array().cast("array<string>")), tx.link_target), lambda x: x.isNotNull()).alias("links"),
        F.length(body).cast("long").alias("char_count"), tx.word_count(body).alias("word_count"),
    )


def migrate_keys(table: DataFrame, old: str, docs: str, bridge: str) -> DataFrame:
    """Replace the column `old` by the path key of its documents and bridge; where either is null it stays."""
    new = F.when(F.col(docs).isNotNull() & F.col(bridge).isNotNull(), tx.path_id(F.col(docs), F.col(bridge))).otherwise(F.col(old))
    return table.withColumn(old, new)
