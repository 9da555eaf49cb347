"""Document graph over shared link targets and direct links: frequencies, weights, edges, types and scores of paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx

#: Words that mark a comparison among shared entities, and words of cause.
COMPARED = ("prize", "award", "medal", "ceo", "president", "founder", "winner", "recipient")
CAUSES = ("caused", "triggered", "resulted", "led", "sparked", "provoked", "after", "because", "due")
#: The share of each type of path in a sample, in order.
TYPE_SHARES = {"bridge_entity": 0.60, "comparison": 0.35, "temporal_chain": 0.30, "cause_effect": 0.20, "definition_application": 0.15}


def postings(articles: DataFrame) -> DataFrame:
    """(entity, doc): distinct."""
    return articles.select(F.col("page_id").alias("doc"), F.explode(tx.link_targets(F.col("links"))).alias("entity"))


def frequencies(posts: DataFrame) -> DataFrame:
    return posts.groupBy("entity").agg(F.count(F.lit(1)).alias("df"))


def rank_percentile(df: DataFrame, col: str, p: float) -> DataFrame:
    """Lower-rank percentile: the value at place floor(n p) from 0, or the last. One row; built on value counts."""
    by = df.groupBy(col).agg(F.count(F.lit(1)).alias("k"))
    run = by.withColumn("upto", F.sum("k").over(Window.orderBy(col)))  # one row for each distinct value
    total = by.agg(F.sum("k").alias("n"))
    return run.join(F.broadcast(total)).filter(F.col("upto") > F.least(F.col("n") - 1, F.floor(F.col("n") * p))).agg(F.min(col).alias("cutoff"))


def weights(freq: DataFrame, n_docs: int, cutoff: int, min_df: int = 2, generic_df: int = 100) -> DataFrame:
    """(entity, df, idf) without rare and generic entities."""
    kept = freq.filter((F.col("df") >= min_df) & ~((F.col("df") > cutoff) & (F.col("df") >= generic_df)))
    return kept.withColumn("idf", F.log(F.lit(float(n_docs)) / F.col("df")))


def direct_links(articles: DataFrame) -> DataFrame:
    """(a, b, weight): a page links to another's title; 2.0 in each direction. The last page with a title has it."""
    t = F.lower(tx.strip(F.col("title")))
    owner = articles.select(t.alias("target"), "page_id").filter("target <> ''").groupBy("target").agg(F.max("page_id").alias("to"))
    link = articles.select(F.col("page_id").alias("src"), F.explode(tx.link_targets(F.col("links"))).alias("target")).join(owner, "target").filter("src <> to")
    return link.select("src", "to").distinct().groupBy(F.least("src", "to").alias("a"), F.greatest("src", "to").alias("b")).agg((F.count(F.lit(1)) * 2.0).alias("weight"))


def edges(posts: DataFrame, idf: DataFrame, direct: DataFrame | None = None, max_df: int = 100, specific: float = 3.0) -> DataFrame:
    """(a, b, weight, direct, shared, n_specific, bridge_idf): pairs of documents that share an entity of at most max_df
    documents, or of which one links to the other (direct: a, b, weight).

    weight adds the shared entities' idf and the direct links' weights; shared goes by falling idf, then by name;
    n_specific counts those above `specific`. max_df bounds the pairs of one entity, so no entity can outgrow a task.
    """
    p = posts.join(idf.filter(F.col("df") <= max_df), "entity")
    q = p.select("entity", F.col("doc").alias("b"))
    pairs = p.select("entity", "idf", F.col("doc").alias("a")).join(q, "entity").filter("a < b")
    e = pairs.select("a", "b", F.col("idf").alias("w"), F.struct(F.negative("idf").alias("x"), "entity").alias("s"), F.lit(False).alias("d"))
    if direct is not None:
        e = e.unionByName(direct.select("a", "b", F.col("weight").alias("w"), F.lit(True).alias("d")), allowMissingColumns=True)
    g = e.groupBy("a", "b").agg(F.sum("w").alias("weight"), F.max("d").alias("direct"), F.array_sort(F.collect_list("s")).alias("s"))
    return g.select("a", "b", "weight", "direct", F.transform("s", lambda x: x["entity"]).alias("shared"), F.size(F.filter("s", lambda x: -x["x"] > specific)).alias("n_specific"), F.negative(F.get("s", F.lit(0))["x"]).alias("bridge_idf"))


def features(articles: DataFrame) -> DataFrame:
    """(doc, title, words, years, causes): what types and scores need of a page (page_id, title, article).

    years: those within the first 2000 characters, distinct and in order; causes: whether a word of cause is within the
    first 500, in any case and as a part of a word too.
    """
    t = tx.text(F.col("article"))
    opening = F.lower(F.substring(t, 1, 500))
    cause = F.lit(False)
    for w in CAUSES:
        cause = cause | F.contains(opening, F.lit(w))
    return articles.select(F.col("page_id").alias("doc"), F.lower(tx.text(F.col("title"))).alias("title"), tx.word_count(t).alias("words"), F.array_sort(F.array_distinct(tx.years(F.substring(t, 1, 2000)))).alias("years"), cause.alias("causes"))


def with_features(e: DataFrame, f: DataFrame) -> DataFrame:
    """Edges with both documents' features, suffixed a and b; documents without any count as empty ones."""
    own = lambda end: f.select(F.col("doc").alias(end), *[F.col(c).alias(c + end) for c in ("title", "words", "years", "causes")])
    d = e.join(own("a"), "a", "left").join(own("b"), "b", "left")
    for end in "ab":
        d = d.withColumns({f"title{end}": F.coalesce(f"title{end}", F.lit("")), f"words{end}": F.coalesce(f"words{end}", F.lit(0)), f"years{end}": F.coalesce(f"years{end}", F.array().cast("array<string>")), f"causes{end}": F.coalesce(f"causes{end}", F.lit(False))})
    return d


def bridge(shared: Column, title_b: Column) -> Column:
    """The shared entity of the largest idf; without one, the second document's title."""
    return F.coalesce(F.get(shared, F.lit(0)), title_b)


def reasoning_type() -> Column:
    """The type of a path of two documents, from the columns of with_features; the first rule that holds."""
    wa, wb, shared = F.col("wordsa"), F.col("wordsb"), F.col("shared")
    words = F.flatten(F.transform(shared, lambda s: F.split(s, r"\s+")))
    some = F.size(shared) > 0
    return (
        F.when(((wa < 400) & (wb >= 600)) | ((wb < 400) & (wa >= 600)), "definition_application")
        .when((F.col("n_specific") >= 2) & F.arrays_overlap(words, tx.literals(COMPARED)), "comparison")
        .when(some & (F.size("yearsa") > 0) & (F.size("yearsb") > 0) & (F.col("yearsa") != F.col("yearsb")), "temporal_chain")
        .when(some & F.col("causesa") & F.col("causesb"), "cause_effect")
        .otherwise("bridge_entity")
    )


def quality(shared: Column, bridge_idf: Column, max_idf: float, titled: Column, least_words: Column, most_words: Column, low: float = 0.2, high: float = 0.9) -> Column:
    """Score of a path within 0..1, 0 without a shared entity. titled: whether the bridge is a document's title."""
    parts = (
        (0.45, F.when((F.coalesce(bridge_idf, F.lit(1.0)) / max_idf).between(low, high), 1.0).otherwise(0.5)),
        (0.25, F.when(titled, 0.4).otherwise(1.0)),
        (0.15, F.when(most_words > 0, least_words / most_words).otherwise(0.0)),
        (0.15, F.least(F.lit(1.0), F.size(shared) / 4)),
    )
    total = sum((w * x for w, x in parts[1:]), start=parts[0][0] * parts[0][1])
    return F.when(F.size(shared) == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))


def path_score(e: DataFrame, f: DataFrame, max_idf: float) -> DataFrame:
    """Add the features of both documents, bridge, kind and score to edges."""
    d = with_features(e, f).withColumn("bridge", bridge(F.col("shared"), F.col("titleb"))).withColumn("kind", reasoning_type())
    titled = (F.col("bridge") == F.col("titlea")) | (F.col("bridge") == F.col("titleb"))
    return d.withColumn("score", quality(F.col("shared"), F.col("bridge_idf"), max_idf, titled, F.least("wordsa", "wordsb"), F.greatest("wordsa", "wordsb")))


def stratified(paths: DataFrame, caps: dict[str, float], n: int) -> DataFrame:
    """First of each type up to its share in the order of caps, then the best of the rest, n in all.

    paths: kind, score and the key a, b, bridge, each of which counts once. Ties go by a, b. Types not in caps have no
    share.
    """
    order, limit = F.lit(len(caps)), F.lit(0)
    for i, (k, share) in reversed(list(enumerate(caps.items()))):
        order = F.when(F.col("kind") == k, F.lit(i)).otherwise(order)
        limit = F.when(F.col("kind") == k, F.lit(max(1, int(share * n)))).otherwise(limit)
    w = Window.partitionBy("kind").orderBy(F.col("score").desc(), "a", "b")
    r = paths.dropDuplicates(["a", "b", "bridge"]).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n).withColumn("late", (F.col("rank") > limit).cast("int"))
    place = [F.col("late"), F.when(F.col("late") == 0, order).otherwise(0), F.col("score").desc(), F.col("a"), F.col("b")]
    return r.orderBy(*place).limit(n).drop("rank", "late")


def neighbours(e: DataFrame, most: int | None = None) -> DataFrame:
    """(a, b): each edge in both directions; with `most`, of each document only its so many heaviest, then least, ones."""
    w = F.round("weight", 6) if "weight" in e.columns else F.lit(0.0)
    both = e.select("a", "b", w.alias("w")).union(e.select(F.col("b").alias("a"), F.col("a").alias("b"), w))
    if most is None:
        return both.select("a", "b")
    order = Window.partitionBy("a").orderBy(F.col("w").desc(), "b")
    return both.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= most).select("a", "b")


def pairs_capped(e: DataFrame, per_node: int = 100) -> DataFrame:
    """(a, b): edges, of which each document starts its per_node heaviest at most."""
    w = Window.partitionBy("a").orderBy(F.round("weight", 6).desc(), "b")
    return e.select("a", "b", "weight").withColumn("k", F.row_number().over(w)).filter(F.col("k") <= per_node).select("a", "b")


def two_hops(e: DataFrame, mids: int | None = None, ends: int | None = None) -> DataFrame:
    """(a, m, b): a-m and m-b are edges, a-b is none; a < b.

    mids, ends: of each document only so many neighbours, the heaviest, are taken as the middle, and of each middle so
    many as the end. Without them a document of many neighbours makes pairs with their square; with them there are at
    most mids * ends for each document.
    """
    left = neighbours(e, mids).select(F.col("b").alias("m"), F.col("a").alias("x"))
    right = neighbours(e, ends).select(F.col("a").alias("m"), F.col("b").alias("y"))
    far = left.join(right, "m").filter("x <> y").select(F.least("x", "y").alias("x"), "m", F.greatest("x", "y").alias("y")).distinct()
    return far.join(e.select(F.col("a").alias("x"), F.col("b").alias("y")), ["x", "y"], "left_anti").select(F.col("x").alias("a"), "m", F.col("y").alias("b"))


def three_document_paths(e: DataFrame, f: DataFrame, idf: DataFrame, max_idf: float, n: int, mids: int = 4, ends: int = 4) -> DataFrame:
    """(a, m, b, bridge, shared, score, weight): the n paths over a middle document with the largest mean weight.

    e as from edges(). shared is the union of both edges' entities; paths without any are left out; ties go by a, m, b.
    """
    links = e.select("a", "b", "weight", "shared")
    way = links.union(links.select("b", "a", "weight", "shared"))
    one, two = (way.select(F.col("a").alias(x), F.col("b").alias(y), F.col("weight").alias(f"w{k}"), F.col("shared").alias(f"s{k}")) for k, x, y in ((1, "a", "m"), (2, "m", "b")))
    t = two_hops(e, mids, ends).join(one, ["a", "m"]).join(two, ["m", "b"]).withColumn("shared", F.array_union("s1", "s2")).filter(F.size("shared") > 0)
    t = t.withColumn("weight", F.round(F.col("w1") + F.col("w2"), 6)).orderBy(F.col("weight").desc(), "a", "m", "b").limit(n)
    best = t.select("a", "m", "b", F.explode("shared").alias("entity")).join(idf.select("entity", "idf"), "entity").groupBy("a", "m", "b").agg(F.min(F.struct(F.negative("idf").alias("x"), "entity")).alias("g"))
    d = t.join(best, ["a", "m", "b"])
    for end in ("a", "m", "b"):
        d = d.join(f.select(F.col("doc").alias(end), F.col("title").alias(f"title{end}"), F.col("words").alias(f"words{end}")), end, "left")
    words = [F.coalesce(f"words{x}", F.lit(0)) for x in ("a", "m", "b")]
    titled = F.coalesce(F.col("g.entity").isin(F.col("titlea"), F.col("titlem"), F.col("titleb")), F.lit(False))
    return d.select("a", "m", "b", F.col("g.entity").alias("bridge"), F.array_sort("shared").alias("shared"), quality(F.col("shared"), F.negative("g.x"), max_idf, titled, F.least(*words), F.greatest(*words)).alias("score"), "weight")
