"""Near duplicates: fast similarity sketches, banding, exact verification on whole shingle sets, components.

Sketch (Dahlgaard, Knudsen and Thorup, 2017): t coordinates; in rounds 0..t-1 every shingle is hashed to a coordinate
and a value, in rounds t..2t-1 to coordinate i-t for sure; a coordinate keeps its least (round, value), and a document
stops when all its coordinates are filled.

A document's class is the set of its shingles: exact copies (equal sets) are one class, and only the member with the
least id takes part further. Within a bucket of a band the members are compared with the bucket's leader, which is
the member with the largest buckets over all bands. Buckets that then still hold several components go on to further
leaders while that helps. The pairs across components that are left are those of a bucket that also share one of their
rarest shingles (the prefix filter: a pair at the threshold must, whatever order the shingles have), so that a passage
common to many documents makes no pairs. So no link that could join two components is lost, and a group of near copies
costs a few pairs for each member, not all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import carried, gathered, mix, prepare, share, slices, spread_join, stash, string_hashes, with_rid


@dataclass(frozen=True)
class Settings:
    """Links need 100 * intersection >= percent * union. A pair at 0.75 is missed with probability under 6e-6."""

    shingle: int = 5
    percent: int = 75
    bands: int = 32
    rows: int = 4
    slice_bytes: int = 2 << 20
    broadcast_rows: int = 200_000
    one_task_links: int = 2_000_000  # stars joined in one task at most (32 MB)


def shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the distinct k-word shingles of each text as sorted 64-bit hashes, lower-cased A-Z.

    A text with fewer words has its whole word sequence as one shingle; one without words (or null) has none.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    off = np.asarray(lists.offsets, dtype=np.int64)
    flat = lists.values.slice(int(off[0]), int(off[-1] - off[0]))
    enc = flat.dictionary_encode()
    code = np.asarray(enc.indices, dtype=np.int64)
    hashes = string_hashes(enc.dictionary)
    empty = np.asarray(pc.equal(enc.dictionary, ""), dtype=bool)
    doc = np.repeat(np.arange(len(lists)), np.diff(off))
    if empty.any():
        real = ~empty[code]
        code, doc = code[real], doc[real]
    w = hashes[code]
    n = np.bincount(doc, minlength=len(lists))
    first = np.concatenate([[0], np.cumsum(n)])
    sd, sh = [], []
    if len(w) >= k:
        h = np.zeros(len(w) - k + 1, np.uint64)
        for j in range(k):
            h = mix(h ^ w[j : len(w) - k + 1 + j], j + 1)
        inside = doc[: len(h)] == doc[k - 1 :]
        sd.append(doc[: len(h)][inside])
        sh.append(h[inside])
    for d in np.flatnonzero((n > 0) & (n < k)):
        h = np.zeros(1, np.uint64)
        for j in range(n[d]):
            h = mix(h ^ w[first[d] + j : first[d] + j + 1], j + 1)
        sd.append(np.array([d]))
        sh.append(mix(h, 99))
    if not sd:
        return np.zeros(0, np.uint64), np.zeros(len(lists) + 1, np.int64)
    d, h = np.concatenate(sd), np.concatenate(sh)
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    d, h = d[new], h[new]
    return h, np.concatenate([[0], np.cumsum(np.bincount(d, minlength=len(lists)))])


def sketch(h: np.ndarray, off: np.ndarray, t: int) -> np.ndarray:
    """Fast similarity sketches of all sets at once: array (sets, t); empty sets have all ones."""
    m, top = len(off) - 1, np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(m * t, top, np.uint64)
    size = np.diff(off)
    todo = np.flatnonzero(size > 0)
    for r in range(2 * t):
        if not len(todo):
            break
        n = size[todo]
        row = np.repeat(todo, n)
        at = np.repeat(off[todo] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        v = mix(h[at], 1000 + r)
        place = (v % np.uint64(t)).astype(np.int64) if r < t else np.full(len(v), r - t, np.int64)
        v = (v >> np.uint64(8)) | (np.uint64(min(r, 255)) << np.uint64(56))  # the round goes first
        np.minimum.at(out, row * t + place, v)
        todo = todo[(out.reshape(m, t)[todo] == top).any(1)]
    return out.reshape(m, t)


def _signatures(s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", s.slice_bytes):
                h, off = shingles(b.column("text"), s.shingle)
                size = np.diff(off)
                sk = sketch(h, off, s.bands * s.rows)
                acc = np.zeros((2, len(size)), np.uint64)
                for j, salt in enumerate((7, 8)):  # 128-bit digest of the whole set: sums of independent hashes
                    c = np.concatenate([[np.uint64(0)], np.cumsum(mix(h, salt), dtype=np.uint64)])
                    acc[j] = mix(c[off[1:]] - c[off[:-1]] + size.astype(np.uint64), salt)
                bands = np.zeros((len(size), s.bands), np.uint64)
                for j in range(s.rows):
                    bands = mix(bands ^ sk[:, j :: s.rows], 50 + j)
                yield pa.record_batch([
                    b.column("_rid"), b.column("doc_id"), pa.array(size, pa.int64()), pa.array(acc[0].view(np.int64)), pa.array(acc[1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1) * s.bands, pa.int32()), pa.array(bands.reshape(-1).view(np.int64))),
                ], names=["_rid", "doc_id", "n_shingles", "d1", "d2", "bands"])

    return run


def _sets(s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", s.slice_bytes):
                h, off = shingles(b.column("text"), s.shingle)
                yield pa.record_batch([b.column("_rid"), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(h.view(np.int64)))], names=["r", "s"])

    return run


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, least node that each reaches) of the links a - b: hooking to the least label and pointer jumping."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while len(u):
        low = np.minimum(label[u], label[v])
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        open_ = label[u] != label[v]
        u, v = u[open_], v[open_]
    return nodes, nodes[label]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a partition as (node, least node it reaches within the partition)."""
    known = None
    for b in batches:
        x, y = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if known is not None:
            x, y = np.concatenate([known[0], x]), np.concatenate([known[1], y])
        known = _roots(x, y)
    if known is not None:
        for i in range(0, len(known[0]), 1 << 16):
            yield pa.record_batch([pa.array(k[i : i + (1 << 16)]) for k in known], names=["r", "c"])


def components(links: DataFrame, one_task: int) -> DataFrame:
    """(r, c) for every end of links (a, b): c is the least id that r reaches.

    Each partition first reduces its links to stars. If at most one_task of their rows are left, one task of that
    bounded size joins them; beyond, large-star and small-star rounds do, over any number of tasks.
    """
    e = stash(links.mapInArrow(_forest, "r long, c long"), "stars")
    if e.count() <= one_task:
        return stash(e.coalesce(1).mapInArrow(_forest, "r long, c long"), "components")
    own = e.select("r").distinct().withColumn("c", F.col("r"))  # the least nodes have no link of their own
    e = stash(e.filter("r != c").select(F.col("r").alias("u"), F.col("c").alias("v")).distinct(), "links")
    most = share(2 * e.count(), links.sparkSession)
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_n")).withColumn("m", F.least("u", "m"))
        big = spread_join(both, least.drop("_n"), ["u"], least, most).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        big = stash(big, "large")
        low = big.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_n"))
        small = spread_join(big, low.drop("_n"), ["u"], low, most).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").union(low.select("u", F.col("m").alias("v"))).distinct()
        new = stash(small, "small")
        if new.exceptAll(e).limit(1).count() == 0 and e.exceptAll(new).limit(1).count() == 0:
            return stash(own.join(new.select(F.col("u").alias("r"), F.col("v").alias("v")), "r", "left").select("r", F.coalesce("v", "c").alias("c")), "components")
        e = new


def _confirmed(pair: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Of pairs (r, q) with set sizes (n, m), those that are links, by their whole sets: (a, b)."""
    pair = pair.filter(100 * F.least("n", "m") >= s.percent * F.greatest("n", "m")).select(F.least("r", "q").alias("a"), F.greatest("r", "q").alias("b")).distinct()
    pair = stash(pair, "pairs")
    most = share(pair.count(), pair.sparkSession)  # a leader may be in very many pairs
    hot = {end: stash(pair.groupBy(end).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most), "hot") for end in ("a", "b")}
    for end in ("a", "b"):
        pair = spread_join(pair, sets.select(F.col("r").alias(end), F.col("s").alias(f"s{end}")), [end], hot[end], most)
    both = F.size(F.array_intersect("sa", "sb"))
    return stash(pair.filter(100 * both >= s.percent * (F.size("sa") + F.size("sb") - both)).select("a", "b"), "found")


def _settle(member: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """All links across components among members (r, n, c): pairs that share a shingle of both prefixes, confirmed.

    Shingles are ordered by their frequency among the members, then by hash. Of a set of n, a partner at the threshold
    holds at least percent of n, so the pair shares one of the first n - ceil(percent * n / 100) + 1 of either.
    """
    who = member.select("r", "n", "c").distinct()
    each = stash(sets.join(who, "r").select("r", "n", "c", F.explode("s").alias("w")), "each")
    freq = each.groupBy("w").agg(F.count(F.lit(1)).alias("f"))
    first = F.row_number().over(Window.partitionBy("r").orderBy("f", "w"))
    size = F.col("n") - F.ceil(F.col("n") * s.percent / 100) + 1
    most = share(each.count(), each.sparkSession)
    freq = stash(freq, "frequencies")
    counts = freq.select("w", F.col("f").alias("_n"))
    head = spread_join(each, freq, ["w"], counts, most).withColumn("k", first).filter((F.col("k") <= size) & (F.col("f") > 1)).select("w", "r", "n", "c", "k")
    head = stash(head, "prefixes")
    mixed = head.groupBy("w").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("w")
    head = stash(spread_join(head, mixed, ["w"], counts, most, "left_semi"), "shared")
    # sizes go in classes a factor of 1.05 apart: the larger of a pair meets each class below it by itself, with the
    # shorter prefix that sizes so near allow; the smaller one needs the prefix for partners of its own size
    step, t = 1.05, s.percent / (100 + s.percent)
    head = head.withColumn("g", F.floor(F.log("n") / math.log(step)))
    small = head.filter(F.col("k") <= F.col("n") - F.ceil(F.lit(2 * t) * F.col("n") - 1e-6) + 1)
    large = head.select("w", F.col("r").alias("q"), F.col("n").alias("m"), F.col("c").alias("d"), F.col("k").alias("l"), "g")
    below = math.ceil(math.log(100 / s.percent) / math.log(step)) + 1
    large = large.withColumn("e", F.explode(F.array(*[F.lit(i) for i in range(below + 1)]))).withColumn("g", F.col("g") - F.col("e")).drop("e")
    least = F.greatest(F.floor(F.pow(F.lit(step), F.col("g"))) - 1, F.ceil(F.col("m") * s.percent / 100))
    large = large.filter(F.col("l") <= F.col("m") - F.ceil(F.lit(t) * (least + F.col("m")) - 1e-6) + 1)
    ordered = (F.col("c") != F.col("d")) & (F.col("n") <= F.col("m")) & ((F.col("n") < F.col("m")) | (F.col("r") < F.col("q")))
    # at its first common shingle a pair at the threshold still has enough shingles to come on either side
    enough = (100 + s.percent) * (1 + F.least(F.col("n") - F.col("k"), F.col("m") - F.col("l"))) >= s.percent * (F.col("n") + F.col("m"))
    pair = small.join(large, ["w", "g"]).filter(ordered & (100 * F.col("n") >= s.percent * F.col("m")) & enough)
    return _confirmed(stash(pair.select("r", "n", "q", "m").distinct(), "near"), sets, s)


def _joined(comp: DataFrame | None, found: DataFrame, s: Settings) -> DataFrame:
    """Components of the links found, on top of those known."""
    return components(found if comp is None else comp.select(F.col("r").alias("a"), F.col("c").alias("b")).union(found), s.one_task_links)


def near_duplicates(docs: DataFrame, s: Settings = Settings(), numbered: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept (and the row id _rid).

    component_id is the least doc_id that links reach, kept whether it is the own one. A null or wordless text has an
    empty set and is linked with nothing, not even with another empty one. Copies are linked through their class.
    Repeated or null doc_ids: each row is a document of its own; of rows with the least id of a component, the first
    is kept. An empty table gives an empty result. Only _rid, doc_id and text are read; other columns may have any name.
    numbered: docs has its _rid from with_rid already; a second numbering of repeated ids may differ from the first.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select("_rid", "doc_id", "text") if numbered else with_rid(docs.select("doc_id", "text"))
    schema = "_rid long, doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"
    sig = stash(docs.select("_rid", F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_signatures(s), schema), "signatures")
    real = sig.filter("n_shingles > 0")
    classes = stash(real.groupBy("d1", "d2").agg(F.min(F.struct("_rid", "doc_id")).alias("f"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n"), F.count(F.lit(1)).alias("_n")), "classes")
    rows = classes.select(F.col("f._rid").alias("r"), F.col("n"), F.posexplode("bands").alias("band", "h"))
    sizes = stash(rows.groupBy("band", "h").agg(F.count(F.lit(1)).alias("k")).filter("k > 1"), "sizes")
    most = share(s.bands * classes.count(), spark)
    member = stash(spread_join(rows, sizes, ["band", "h"], sizes.withColumnRenamed("k", "_n"), most).select("band", "h", "k", "r", "n"), "members")
    rank = member.groupBy("r").agg(F.sum("k").alias("weight"))
    member = stash(member.join(rank, "r"), "ranked")
    ids = member.select("r").distinct()
    few = ids.count() <= s.broadcast_rows
    sets = docs.join(F.broadcast(ids) if few else ids, F.col("_rid") == F.col("r"), "left_semi")
    sets = stash(sets.select("_rid", "text").mapInArrow(_sets(s), "r long, s array<long>"), "sets")
    comp, before = None, None
    member = member.withColumn("c", F.col("r"))
    hot = sizes.withColumnRenamed("k", "_n")
    leaders = 1
    while True:
        # leaders of each bucket: the members not yet used with the largest buckets; the others are compared with them
        by = Window.partitionBy("band", "h").orderBy(F.col("weight").desc(), "r")
        lead = member.withColumn("at", F.row_number().over(by)).filter(F.col("at") <= leaders).select("band", "h", F.col("r").alias("q"), F.col("n").alias("m"), F.col("c").alias("d"))
        comp = _joined(comp, _confirmed(spread_join(member, lead, ["band", "h"], hot, most).filter("c != d").select("r", "n", "q", "m"), sets, s), s)
        # buckets that still hold two components, without the leaders just used
        left = member.drop("c").join(comp, "r", "left").withColumn("c", F.coalesce("c", "r"))
        left = left.join(lead.select("band", "h", F.col("q").alias("r")), ["band", "h", "r"], "left_anti")
        held = left.groupBy("band", "h", "c").agg(F.count(F.lit(1)).alias("j")).groupBy("band", "h").agg(F.sum("j").alias("j"), F.sum(F.col("j") * F.col("j")).alias("j2"), F.count(F.lit(1)).alias("cs")).filter("cs > 1")
        held = held.select("band", "h", ((F.col("j") * F.col("j") - F.col("j2")) / 2).alias("open"))
        member = stash(spread_join(left, held, ["band", "h"], hot, most).select("r", "band", "h", "n", "weight", "c", "open"), "open")
        count = member.dropDuplicates(["band", "h"]).agg(F.coalesce(F.sum("open"), F.lit(0))).first()[0]
        if count == 0:
            break
        if before is not None and 2 * count > before:
            comp = _joined(comp, _settle(member, sets, s), s)
            break
        before = count
        member = member.drop("open")
        leaders *= 4  # so that rounds stay few; no pair is compared more often for it
    label = classes.select(F.col("f._rid").alias("r"), F.col("f.doc_id").alias("own"), "d1", "d2").join(comp, "r", "left").withColumn("c", F.coalesce("c", "r"))
    names = classes.select(F.col("f._rid").alias("c"), F.col("f.doc_id").alias("component_id"))
    label = stash(label, "labels")
    most = share(label.count(), spark)
    label = spread_join(label, names, ["c"], label.groupBy("c").agg(F.count(F.lit(1)).alias("_n")), most).select("d1", "d2", F.col("c"), "component_id")
    out = spread_join(sig.drop("bands"), label, ["d1", "d2"], classes.select("d1", "d2", "_n"), share(sig.count(), spark), "left").withColumn("lone", F.col("n_shingles") == 0)
    c = F.when(F.col("lone"), F.col("_rid")).otherwise(F.col("c"))
    return out.select("_rid", "doc_id", "n_shingles", F.when(F.col("lone"), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), (F.col("_rid") == c).alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("_rid")


#: DuckDB: brute force over all pairs that share a shingle, and components by reaching the least id, for the query.
SQL = r"""
with recursive d as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') as w from documents),
s as materialized (select distinct doc_id, md5(x) as s from (select doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) when len(w) > 0 then ['<' || array_to_string(w, ' ')] else [] end) as x from d)),
n as materialized (select doc_id, count(*) as n from s group by 1),
link as materialized (select a, b from (select x.doc_id as a, y.doc_id as b, count(*) as k from s x join s y using (s) where x.doc_id <> y.doc_id group by 1, 2) p join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * k >= 75 * (na.n + nb.n - k)),
r(doc_id, c) as (select doc_id, doc_id from d union select link.b, r.c from r join link on link.a = r.doc_id where r.c < link.b),
g as (select doc_id, min(c) as component_id from r group by 1)
select doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, component_id, doc_id = component_id as kept from g left join n using (doc_id)
"""


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near duplicates stays, the one with the least doc_id, with all its
    columns, of any name. Null and wordless texts are in no group and stay. Repeated or null doc_ids: each row is a
    document of its own, numbered once. An empty table gives an empty result.
    """
    prepare(spark)
    named = with_rid(carried(docs, "doc_id", "text"))
    gone = near_duplicates(named, numbered=True).filter("not kept").select("_rid")
    return gathered(named.join(gone, "_rid", "left_anti").select("_row.*"))
