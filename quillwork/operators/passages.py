"""Choosing, joining and locating the chunks of documents. Chunks: doc, idx, chunk_text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx


def hints(chunks: DataFrame, entities: DataFrame, k: int = 3) -> DataFrame:
    """For each (doc, entity): the first k chunks that hold the entity in any case, else the first k. doc, entity, idx."""
    c = chunks.join(entities, "doc").withColumn("miss", ~F.contains(F.lower(tx.text(F.col("chunk_text"))), F.lower("entity")))
    w = Window.partitionBy("doc", "entity")
    c = c.withColumn("k", F.row_number().over(w.orderBy("miss", "idx"))).filter(F.col("k") <= k)
    # rows are few now: if the first is a hit, misses go
    return c.withColumn("none", F.min("miss").over(w)).filter(~F.col("miss") | F.col("none")).select("doc", "entity", "idx")


def leading_text(chunks: DataFrame, most: int = 6000) -> DataFrame:
    """Per document its first chunks by line, up to and with the one that reaches `most` characters. doc, text, n_chunks."""
    w = Window.partitionBy("doc").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    body = tx.text(F.col("chunk_text"))
    c = chunks.withColumn("before", F.coalesce(F.sum(F.length(body)).over(w), F.lit(0))).filter(F.col("before") < most)
    rows = F.array_sort(F.collect_list(F.struct("idx", body.alias("t"))))
    return c.groupBy("doc").agg(F.array_join(F.transform(rows, lambda x: x["t"]), "\n").alias("text"), F.count(F.lit(1)).alias("n_chunks"))


def clean_span(c: Column) -> Column:
    """White space off, then quotes."""
    return F.regexp_replace(tx.strip(c), "^[\"']+|[\"']+$", "")


def map_spans(spans: DataFrame, chunks: DataFrame) -> DataFrame:
    """(id, doc, span): the first chunk of the document that holds the span, and its place there. id, doc, idx, start, end.

    If chunks have chunk_id or start_char, chunk_id, start_char and end_char (in the document) come too. Spans that are
    empty or in no chunk have no row; a span given twice has one.
    """
    s = spans.filter(F.col("span") != "").withColumn("span", clean_span(F.col("span"))).distinct()
    hit = s.join(chunks, "doc").withColumn("start", F.expr("locate(span, coalesce(chunk_text, ''))") - 1).filter("start >= 0")
    w = Window.partitionBy("id", "doc", "span").orderBy("idx")
    first = hit.withColumn("k", F.row_number().over(w)).filter("k = 1")
    more = [F.col("chunk_id")] if "chunk_id" in chunks.columns else []
    if "start_char" in chunks.columns:
        at = F.coalesce("start_char", F.lit(0)) + F.col("start")
        more += [at.alias("start_char"), (at + F.length("span")).alias("end_char")]
    return first.select("id", "doc", "idx", "start", (F.col("start") + F.length("span")).alias("end"), *more)


#: Fixed value: letters of the documents of a path.
LETTERS = "ABCDEFGHIJKLMNOP"


def chosen_chunks(documents: DataFrame, chunks: DataFrame, hinted: DataFrame, k: int = 3) -> DataFrame:
    """(path, pos, doc, texts): of each document of a path up to k chunks, hinted ones first, each kind in order.

    documents: path, pos, doc; chunks: doc, idx, chunk_text; hinted: path, doc, idx. Documents without chunks have an
    empty array.
    """
    h = hinted.select("path", "doc", "idx", F.lit(0).alias("late")).distinct()
    c = documents.join(chunks.select("doc", "idx", "chunk_text"), "doc").join(h, ["path", "doc", "idx"], "left").withColumn("late", F.coalesce("late", F.lit(1)))
    w = Window.partitionBy("path", "pos").orderBy("late", "idx")
    c = c.withColumn("k", F.row_number().over(w)).filter(F.col("k") <= k)
    texts = c.groupBy("path", "pos").agg(F.array_sort(F.collect_list(F.struct("k", tx.text(F.col("chunk_text")).alias("t")))).alias("x"))
    return documents.join(texts, ["path", "pos"], "left").select("path", "pos", "doc", F.transform(F.coalesce("x", F.array().cast("array<struct<k:int,t:string>>")), lambda x: x["t"]).alias("texts"))


def block(letter, doc_id: Column, title: Column, texts: Column, most: int | None = None) -> Column:
    """A document's block of a prompt: a heading, then its chunks by line, each cut to most characters. Fixed value: the
    heading's form."""
    letter = F.lit(letter) if isinstance(letter, str) else letter
    head = F.concat(F.lit("--- Document "), letter, F.lit(" (doc_id: "), doc_id.cast("string"), F.lit(', title: "'), tx.text(title), F.lit('") ---'))
    cut = texts if most is None else F.transform(texts, lambda t: F.substring(t, 1, most))
    return F.array_join(F.concat(F.array(head), cut, F.array(F.lit(""))), "\n")


def documents_block(documents: DataFrame, chunks: DataFrame, hinted: DataFrame, titles: DataFrame, k: int = 3, most: int = 1500) -> DataFrame:
    """(path, block): the documents of a path in order, lettered from A. titles: doc, title; a document without one has an
    empty title."""
    d = chosen_chunks(documents, chunks, hinted, k).join(titles.select("doc", "title"), "doc", "left")
    letter = F.substring(F.lit(LETTERS), F.col("pos") + 1, F.lit(1))
    one = d.select("path", "pos", block(letter, F.col("doc"), F.col("title"), F.col("texts"), most).alias("t"))
    return one.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "t"))), lambda x: x["t"]), "\n").alias("block"))


#: The fields of a candidate's block of a prompt, in order.
CANDIDATE_FIELDS = ("query", "short_answer", "long_answer", "bridge_entity", "reasoning_type", "reasoning_chain")


def candidates_block(candidates: DataFrame) -> DataFrame:
    """(path, block): the candidates of a path in the order of idx, numbered from 0. path, idx and the fields; missing
    ones are empty."""
    w = Window.partitionBy("path").orderBy("idx")
    c = candidates.withColumn("pos", F.row_number().over(w) - 1)
    lines = [F.concat(F.lit("--- CANDIDATE "), F.col("pos").cast("string"), F.lit(" ---"))]
    lines += [F.concat(F.lit(f"{f}: "), tx.text(F.col(f)) if f in candidates.columns else F.lit("")) for f in CANDIDATE_FIELDS]
    one = c.select("path", "pos", F.array_join(F.array(*lines, F.lit("")), "\n").alias("t"))
    return one.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "t"))), lambda x: x["t"]), "\n").alias("block"))


def fill(template: str, **values: Column) -> Column:
    """A prompt: each {name} of the template is replaced by a column, literally; other braces stay."""
    out = F.lit(template)
    for name, c in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), tx.text(c))
    return out
