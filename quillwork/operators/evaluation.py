"""Measures of answers and of a finished dataset: token F1, distributions, quality gates, final records, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx


def overlap(a: Column, b: Column) -> Column:
    """Tokens that two arrays share, each as often as the array that has it less often has it."""
    count = lambda arr, w: F.size(F.filter(arr, lambda x: x == w))
    return F.aggregate(F.array_distinct(a), F.lit(0), lambda s, w: s + F.least(count(a, w), count(b, w)))


def answer_scores(pred: Column, gold: Column) -> tuple[Column, Column]:
    """(F1 of the tokens, exact match) of normalised answers. If either has no token, F1 is 0; two of them match."""
    p, g = tx.normal_answer(pred), tx.normal_answer(gold)
    split = lambda c: F.filter(F.split(c, " "), lambda w: w != "")
    a, b = split(p), split(g)
    n = overlap(a, b)
    return F.when(n > 0, 2 * n / (F.size(a) + F.size(b))).otherwise(0.0), F.when(p == g, 1.0).otherwise(0.0)


def mean(c: Column, places: int) -> Column:
    """Rounded mean of an aggregation, 0 of nothing. Halves go away from zero."""
    return F.round(F.coalesce(F.avg(c), F.lit(0.0)), places)


def histogram(c: Column, edges: list[int]) -> Column:
    """Counts of [edges[i], edges[i + 1]) as an array, in an aggregation; what is beyond the last edge is in the last one."""
    bins = []
    for i in range(len(edges) - 1):
        inside = (c >= edges[i]) & (c < edges[i + 1])
        bins.append(F.count_if(inside | (c >= edges[-1]) if i == len(edges) - 2 else inside))
    return F.array(*bins)


#: Edges of the histograms of words.
EDGES = {"query": [0, 8, 12, 16, 20, 30, 60], "short_answer": [0, 1, 2, 3, 4, 6, 10], "long_answer": [0, 40, 60, 80, 100, 120, 200]}


def lengths(records: DataFrame) -> DataFrame:
    """(field, n, mean, counts): mean and histogram of the words of query, short_answer and long_answer."""
    words = records.select(*[tx.word_count(F.col(f)).alias(f) for f in EDGES])
    cols = [F.struct(F.lit(f).alias("field"), F.count(F.lit(1)).alias("n"), mean(F.col(f), 2).alias("mean"), histogram(F.col(f), e).alias("counts")) for f, e in EDGES.items()]
    return words.agg(F.array(*cols).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def shares(df: DataFrame, columns: list[str]) -> DataFrame:
    """(field, value, n, share): how often each value of the columns occurs; null counts as a value."""
    each = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")).select("x.*")
    n = each.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("field")), 4))


#: What each gate asks for.
GATES = {"multihop_rate": 0.95, "avg_quality_score": 0.70, "max_reasoning_type_share": 0.60, "min_accepted_pct": 0.90, "bm25_recall_at_10_max": 0.70, "reader_f1_max": 0.60}
#: The gates that ask for no more than their threshold.
CEILINGS = ("max_reasoning_type_share", "bm25_recall_at_10_max", "reader_f1_max")


def gates(records: DataFrame, target: int, recall: float, f1: float, thresholds: dict[str, float] = GATES) -> DataFrame:
    """(gate, value, threshold, pass) of records (reasoning_type, quality_score, hop_count); of no records all values of
    them are 0. Missing quality counts as 0, missing hop counts as 2."""
    types = records.groupBy("reasoning_type").agg(F.count(F.lit(1)).alias("k"), F.sum(F.coalesce("quality_score", F.lit(0.0))).alias("q"), F.count_if(F.coalesce("hop_count", F.lit(2)) >= 2).alias("h"))
    one = types.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n"), F.sum("q").alias("q"), F.sum("h").alias("h"), F.max("k").alias("top"))
    part = lambda c: F.when(F.col("n") > 0, c / F.col("n")).otherwise(0.0)
    values = {
        "multihop_rate": part(F.col("h")), "avg_quality_score": part(F.col("q")), "max_reasoning_type_share": part(F.col("top")),
        "min_accepted_pct": F.col("n") / target if target else F.lit(0.0), "bm25_recall_at_10_max": F.lit(float(recall)), "reader_f1_max": F.lit(float(f1)),
    }
    rows = [F.struct(F.lit(k).alias("gate"), F.round(values[k], 6).alias("value"), F.lit(t).alias("threshold"), (values[k] <= t if k in CEILINGS else values[k] >= t).alias("pass")) for k, t in thresholds.items()]
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def escalation(found: DataFrame) -> str:
    """`escalate` if all gates pass, else `stop`."""
    return "escalate" if found.agg(F.every("pass")).first()[0] else "stop"


def annotate(records: DataFrame, titles: DataFrame, types: DataFrame, mixed: DataFrame) -> DataFrame:
    """Final records in the order of falling quality, then path: query_id, path, question, short, reasoning_type, hop_count,
    answer_type, documents array<struct<doc, title, grade, source>>.

    records: path, question, short, reasoning_type, quality, docs array<struct<doc, grade>>; titles: doc, title; types:
    path, reasoning_type, which goes before the record's own unless null or empty; mixed: query (a path), doc, source,
    place. Supporting documents come in their order and have no source; distractors follow with grade 0. Unknown
    documents have an empty title. hop_count counts supporting documents of grade 2 or more. query_id numbers from 0.
    """
    sup = records.select("path", F.posexplode("docs").alias("at", "d")).select("path", F.col("at").alias("k"), F.col("d.doc").alias("doc"), F.coalesce("d.grade", F.lit(0)).alias("grade"), F.lit(None).cast("string").alias("source"))
    far = mixed.select(F.col("query").alias("path"), (F.lit(1_000_000) + F.col("place")).cast("int").alias("k"), "doc", F.lit(0).alias("grade"), "source")
    d = sup.unionByName(far).join(titles.select("doc", "title"), "doc", "left")
    all_ = d.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("k", "doc", tx.text(F.col("title")).alias("title"), "grade", "source"))).alias("x"))
    own = types.groupBy("path").agg(F.min(F.nullif("reasoning_type", F.lit(""))).alias("own"))
    r = records.join(all_, "path", "left").join(own, "path", "left")
    number = F.row_number().over(Window.orderBy(F.col("quality").desc(), "path")) - 1  # the finished records only
    docs = F.transform(F.coalesce("x", F.array().cast("array<struct<k:int,doc:bigint,title:string,grade:int,source:string>>")), lambda x: F.struct(x["doc"].alias("doc"), x["title"].alias("title"), x["grade"].alias("grade"), x["source"].alias("source")))
    hops = F.size(F.filter("docs", lambda x: x["grade"] >= 2))
    return r.select(F.format_string("q_%05d", number).alias("query_id"), "path", "question", "short", F.coalesce("own", "reasoning_type").alias("reasoning_type"), F.greatest(hops, F.lit(0)).alias("hop_count"), tx.answer_type(F.col("short")).alias("answer_type"), docs.alias("documents"))


def samples(records: DataFrame, key: str, score: str, best: int = 5, worst: int = 3) -> DataFrame:
    """(kind, place, key, score): the records of the largest score, and of three or more the last of that order."""
    top = records.orderBy(F.col(score).desc_nulls_last(), key).limit(best)
    n = records.count()
    low = records.orderBy(F.col(score).asc_nulls_first(), F.col(key).desc()).limit(worst if n >= worst else 0)
    number = lambda df, kind, order: df.select(F.lit(kind).alias("kind"), F.row_number().over(Window.orderBy(*order)).alias("place"), key, score)
    return number(top, "best", [F.col(score).desc_nulls_last(), key]).union(number(low, "worst", [F.col(score).desc_nulls_last(), key]))


def markdown(df: DataFrame, most: int = 200) -> str:
    """A table of a small frame in Markdown; at most so many rows."""
    rows = df.limit(most).collect()
    cell = lambda v: "" if v is None else f"{v:.4f}".rstrip("0").rstrip(".") if isinstance(v, float) else str(v).replace("|", "\\|")
    lines = [df.columns, ["---"] * len(df.columns), *[[cell(v) for v in r] for r in rows]]
    return "\n".join("| " + " | ".join(x) + " |" for x in lines) + "\n"


def report(title: str, **tables: DataFrame) -> str:
    """A Markdown report: a heading for each table, underscores as spaces."""
    return f"# {title}\n" + "".join(f"\n## {k.replace('_', ' ')}\n\n{markdown(df)}" for k, df in tables.items())
