"""Scans of the input tables and adapters to the logical inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tolerant scan: blank and malformed lines are skipped."""
    raw = spark.read.text(path).filter(F.btrim("value") != "").filter(F.try_parse_json("value").isNotNull())
    return raw.select(F.from_json("value", schema).alias("r")).select("r.*")


def hrefs(html: Column) -> Column:
    return F.regexp_extract_all(tx.text(html), F.lit('href="([^"]*)"'), F.lit(1))


def title(html: Column) -> Column:
    return F.regexp_extract(tx.text(html), "<title>([^<]*)</title>", 1)


def bare_text(html: Column) -> Column:
    return F.regexp_replace(tx.text(html), "<[^>]*>", " ")


def articles(pages: DataFrame) -> DataFrame:
    """pages as articles: page_id, title, url, article, links (hrefs)."""
    return pages.select("page_id", title(F.col("html")).alias("title"), "url", bare_text(F.col("html")).alias("article"), hrefs(F.col("html")).alias("links"))


def named_articles(pages: DataFrame) -> DataFrame:
    """Articles whose title is a slash and the letters that the page's title starts with, as links name them: pages link
    to each other by it."""
    return articles(pages).withColumn("title", F.concat(F.lit("/"), F.lower(F.regexp_extract("title", r"^[\p{L}]+", 0))))
