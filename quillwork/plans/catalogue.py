"""The query catalogue: each query with DuckDB SQL for the same rows, where SQL has a form."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import chunking, corpus, funnel, graph, passages, retrieval, similarity
from ..sources.scratch import stash
from ..sources.tables import articles, named_articles, table
from .registry import QUERIES, SQL, query

__all__ = ["QUERIES", "SQL"]

WORDS = r"list_filter(regexp_split_to_array({}, '\s+'), lambda x: x <> '')"
TOK = "regexp_extract_all(lower(coalesce({}, '')), '[a-z0-9]+')"
STOPS = "[" + ", ".join(f"'{w}'" for w in dict.fromkeys(tx.STOP)) + "]"
HREFS = "regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)"
POSTS = f"select distinct page_id as doc, trim(lower(url_decode(h))) as entity from (select page_id, unnest({HREFS}) as h from pages) where trim(lower(url_decode(h))) <> '' and not contains(h, '#')"
IDF = f"posts as ({POSTS}), f as (select entity, count(*) as df from posts group by 1), nd as (select count(*) as n from pages), idf as (select entity, df, ln((select n from nd) / df) as idf from f where df >= 2 and not (df > (select df from (select df, row_number() over (order by df) - 1 as k, count(*) over () as m from f) where k = least(m - 1, floor(m * 0.98))) and df >= 100))"
TITLE = "'/' || lower(regexp_extract(regexp_extract(html, '<title>([^<]*)</title>', 1), '^[\\p{L}]+'))"
EDGES = f"""with {IDF}, p as (select doc, entity, idf from posts join idf using (entity) where df <= 100), pr as (select x.doc as a, y.doc as b, x.entity, x.idf from p x join p y on x.entity = y.entity and x.doc < y.doc),
ti as (select page_id as doc, {TITLE} as title from pages), own as (select title, max(doc) as dst from ti group by 1),
dl as (select least(doc, dst) as a, greatest(doc, dst) as b, count(*) * 2.0 as w from (select distinct doc, dst from posts join own on entity = title where doc <> dst) group by 1, 2),
se as (select a, b, sum(idf) as w, count(*) as n, count(*) filter (idf > 3.0) as spec, max(idf) as m, list(entity order by idf desc, entity) as shared from pr group by 1, 2),
e as (select coalesce(se.a, dl.a) as a, coalesce(se.b, dl.b) as b, coalesce(se.w, 0) + coalesce(dl.w, 0) as weight, dl.w is not null as direct, coalesce(n, 0) as n, coalesce(spec, 0) as spec, m, coalesce(shared, []::varchar[]) as shared from se full join dl on se.a = dl.a and se.b = dl.b)"""


def _arts(spark, d) -> DataFrame:
    return articles(table(spark, d, "pages"))


def _idf(spark, d):
    posts = stash(graph.postings(_arts(spark, d)), "postings")
    freq = stash(graph.frequencies(posts), "frequencies")
    n = table(spark, d, "pages").count()
    cutoff = graph.rank_percentile(freq, "df", 0.98).first()[0] or 0
    return posts, graph.weights(freq, n, cutoff)


def _named(spark, d) -> DataFrame:
    return named_articles(table(spark, d, "pages"))


def _edges(spark, d) -> DataFrame:
    return graph.edges(*_idf(spark, d), graph.direct_links(_named(spark, d)))


@query("corpus_basic_filter", f"select page_id, cast(length(regexp_replace(html, '<[^>]*>', ' ', 'g')) as bigint) as chars, cast(len({HREFS}) as bigint) as links from pages where length(regexp_replace(html, '<[^>]*>', ' ', 'g')) >= 500 and len({HREFS}) >= 3")
def corpus_basic_filter(spark, d):
    return corpus.passes(_arts(spark, d)).select("page_id", F.length("article").cast("long").alias("chars"), F.size("links").cast("long").alias("links"))


@query("link_targets_norm", POSTS.replace("page_id as doc", "page_id as doc"))
def link_targets_norm(spark, d):
    return graph.postings(_arts(spark, d))


@query("title_keep_first", "select page_id, t as title from (select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as t, row_number() over (partition by lower(trim(regexp_extract(html, '<title>([^<]*)</title>', 1))) order by page_id) as k from pages) where k = 1")
def title_keep_first(spark, d):
    return corpus.one_per_title(_arts(spark, d).select("page_id", "title"))


@query("doc_projection", "select printf('doc_%06d', doc_id) as doc_key, doc_id as source_id, lang as language, cast(length(text) as bigint) as char_count, cast(len(" + WORDS.format("text") + ") as bigint) as word_count from documents")
def doc_projection(spark, d):
    return table(spark, d, "documents").select(F.format_string("doc_%06d", "doc_id").alias("doc_key"), F.col("doc_id").alias("source_id"), F.col("lang").alias("language"), F.length("text").cast("long").alias("char_count"), tx.word_count(F.col("text")).alias("word_count"))


@query("sentence_split_counts", r"select doc_id, cast(len(list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '')) as bigint) as n_sentences, cast(len(" + WORDS.format("text") + ") as bigint) as n_words from documents")
def sentence_split_counts(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(tx.sentences(F.col("text"))).cast("long").alias("n_sentences"), tx.word_count(F.col("text")).alias("n_words"))


CHUNKS = r"""with recursive d as (select doc_id, coalesce(text, '') as t, list_filter(list_transform(string_split(regexp_replace(coalesce(text, ''), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(regexp_replace(x, '^\s+|\s+$', '', 'g'))), lambda x: x <> '') as parts from documents),
sp(doc_id, k, st, en) as (select doc_id, 0, 0, 0 from d where len(parts) > 0 union all select sp.doc_id, sp.k + 1, sp.en + instr(substr(t, sp.en + 1), parts[sp.k + 1]) - 1, sp.en + instr(substr(t, sp.en + 1), parts[sp.k + 1]) - 1 + length(parts[sp.k + 1]) from sp join d using (doc_id) where sp.k < len(parts)),
s as (select doc_id, k, st, en, len(list_filter(regexp_split_to_array(parts[k], '\s+'), lambda x: x <> '')) as w from sp join d using (doc_id) where k > 0),
c as (select doc_id, list(u order by k) as p, list(st order by k) as st, list(en order by k) as en from (select *, sum(w) over (partition by doc_id order by k) as u from s) group by 1),
g as (select doc_id, list_prepend(0, p) as p, len(p) as n, st, en from c),
r(doc_id, i, j, k) as (select doc_id, 0, case when p[n + 1] <= 300 then n else greatest(1, least(n, list_position(list_transform(p, lambda x: x >= 225), true) - 1, len(list_filter(p, lambda x: x <= 300)) - 1)) end, 0 from g
union all select doc_id, ni, greatest(ni + 1, least(n, coalesce(nullif(list_position(list_transform(p, lambda x: x >= p[ni + 1] + 225), true), 0), n + 1) - 1, len(list_filter(p, lambda x: x <= p[ni + 1] + 300)) - 1)), k + 1 from (select r.doc_id, r.k, g.p, g.n, greatest(r.i + 1, len(list_filter(g.p, lambda x: x <= g.p[r.j + 1] - 40)) - 1) as ni from r join g using (doc_id) where r.j < g.n))
"""


@query("chunk_pack", CHUNKS + "select printf('c_%06d_%03d', doc_id, k) as chunk_id, doc_id, cast(k as bigint) as chunk_index, array_to_string(parts[i + 1:j], ' ') as chunk_text, null::varchar as section_title, null::int as page_no, cast(p[j + 1] - p[i + 1] as bigint) as word_count, cast(length(array_to_string(parts[i + 1:j], ' ')) as bigint) as char_count, cast(st[i + 1] as bigint) as start_char, cast(en[j] as bigint) as end_char from r join g using (doc_id) join d using (doc_id)")
def chunk_pack(spark, d):
    return chunking.chunks(table(spark, d, "documents"))


@query("section_title", """with h as (select conv_id, turn, chr(10) || '== ' || coalesce(role, '') || ' ' || turn || ' ==' || chr(10) as head, coalesce(text, '') as t from conversations),
p as (select *, case when turn = min(turn) over (partition by conv_id) then 0 else 1 + sum(length(head) + length(t)) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding) end as st, trim(regexp_replace(head, '[=\\n]', '', 'g')) as title from h), o as (select distinct conv_id, unnest([0, 100, 500, 2000, 100000]) as off from h)
select conv_id, off, max_by(title, st) as title from o join p using (conv_id) where st <= off group by 1, 2""")
def section_title(spark, d):
    """Turns as sections of a raw text: the title at some offsets."""
    head = F.concat(F.lit("\n== "), tx.text(F.col("role")), F.lit(" "), F.col("turn").cast("string"), F.lit(" ==\n"))
    raw = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", F.concat(head, tx.text(F.col("text"))).alias("t")))), lambda x: x["t"]), "").alias("raw"))
    offs = raw.select("conv_id", chunking.sections(F.col("raw")).alias("heads"), F.explode(F.array(*[F.lit(x) for x in (0, 100, 500, 2000, 100000)])).alias("off"))
    return offs.select("conv_id", "off", chunking.section_at(F.col("heads"), F.col("off")).alias("title"))


@query("entity_df_idf", f"with {IDF} select entity, cast(df as bigint) as df, round(idf, 6) as idf from idf")
def entity_df_idf(spark, d):
    return _idf(spark, d)[1].select("entity", "df", F.round("idf", 6).alias("idf"))


@query("df_percentile_cutoff", f"with {IDF} select cast(df as bigint) as cutoff from (select df, row_number() over (order by df) - 1 as k, count(*) over () as m from f) where k = least(m - 1, floor(m * 0.98))")
def df_percentile_cutoff(spark, d):
    return graph.rank_percentile(graph.frequencies(graph.postings(_arts(spark, d))), "df", 0.98)


@query("graph_edges", EDGES + " select a, b, round(weight, 6) as weight, direct, cast(n as bigint) as n_shared from e")
def graph_edges(spark, d):
    return _edges(spark, d).select("a", "b", F.round("weight", 6).alias("weight"), "direct", F.size("shared").cast("long").alias("n_shared"))


@query("graph_direct_edges", EDGES + " select a, b, w::double as weight from dl")
def graph_direct_edges(spark, d):
    return graph.direct_links(_named(spark, d))


CAUSED = " or ".join(f"contains(lower(substr(t, 1, 500)), '{w}')" for w in graph.CAUSES)
LIST = lambda v: "[" + ", ".join(f"'{w}'" for w in v) + "]"
FEATURES = rf"art as (select page_id as doc, regexp_replace(html, '<[^>]*>', ' ', 'g') as t from pages), w as (select doc, title, len(list_filter(regexp_split_to_array(t, '\s+'), lambda x: x <> '')) as words, list_sort(list_distinct(regexp_extract_all(substr(t, 1, 2000), '\b(1[0-9]{{3}}|20[0-9]{{2}})\b', 1))) as years, ({CAUSED}) as causes from art join ti using (doc))"
SCORED = EDGES + f""", {FEATURES}, b as (select e.*, x.title as ta, y.title as tb, x.words as wa, y.words as wb, x.years as ya, y.years as yb, x.causes as ca, y.causes as cb, coalesce(e.shared[1], y.title) as bridge from e join w x on e.a = x.doc join w y on e.b = y.doc),
s as (select *, case when (wa < 400 and wb >= 600) or (wb < 400 and wa >= 600) then 'definition_application' when spec >= 2 and list_has_any(flatten(list_transform(shared, lambda z: regexp_split_to_array(z, '\\s+'))), {LIST(graph.COMPARED)}) then 'comparison' when n > 0 and len(ya) > 0 and len(yb) > 0 and ya <> yb then 'temporal_chain' when n > 0 and ca and cb then 'cause_effect' else 'bridge_entity' end as kind,
case when n = 0 then 0 else greatest(0, least(1, 0.45 * case when m / (select max(idf) from idf) between 0.2 and 0.9 then 1 else 0.5 end + 0.25 * case when bridge in (ta, tb) then 0.4 else 1 end + 0.15 * case when greatest(wa, wb) > 0 then least(wa, wb) / greatest(wa, wb) else 0 end + 0.15 * least(1, n / 4))) end as score from b)"""


def _scored(spark, d) -> DataFrame:
    posts, idf = _idf(spark, d)
    idf = stash(idf, "idf")
    top = idf.agg(F.max("idf")).first()[0] or 1.0
    return graph.path_score(graph.edges(posts, idf, graph.direct_links(_named(spark, d))), graph.features(_named(spark, d)), top)


@query("graph_bridge", SCORED + " select a, b, bridge from s")
def graph_bridge(spark, d):
    return _scored(spark, d).select("a", "b", "bridge")


@query("graph_reasoning_type", SCORED + " select a, b, kind from s")
def graph_reasoning_type(spark, d):
    return _scored(spark, d).select("a", "b", "kind")


@query("graph_path_score", SCORED + " select a, b, bridge, round(score, 6)::double as score from s")
def graph_path_score(spark, d):
    return _scored(spark, d).select("a", "b", "bridge", F.round("score", 6).alias("score"))


@query("path_ids", SCORED + " select a, b, 'p_' || substr(sha1(least(cast(a as varchar), cast(b as varchar)) || '|' || greatest(cast(a as varchar), cast(b as varchar)) || '||' || bridge), 1, 12) as path_id from s")
def path_ids(spark, d):
    return _scored(spark, d).select("a", "b", tx.path_id(F.array(F.col("a").cast("string"), F.col("b").cast("string")), F.col("bridge")).alias("path_id"))


@query("migrate_path_ids", SCORED + ", o as (select a, b, case when a % 3 = 0 then null else bridge end as bridge from s) select a, b, case when bridge is null then 'old' else 'p_' || substr(sha1(least(cast(a as varchar), cast(b as varchar)) || '|' || greatest(cast(a as varchar), cast(b as varchar)) || '||' || bridge), 1, 12) end as path_id from o")
def migrate_path_ids(spark, d):
    """Keys made anew; where a page number is divisible by three the bridge is taken as lost and the old key stays."""
    old = _scored(spark, d).select("a", "b", F.array(F.col("a").cast("string"), F.col("b").cast("string")).alias("docs"), F.when(F.col("a") % 3 != 0, F.col("bridge")).alias("bridge"), F.lit("old").alias("path_id"))
    return corpus.migrate_keys(old, "path_id", "docs", "bridge").select("a", "b", "path_id")


@query("graph_top_paths", SCORED + " select a, b, bridge, round(score, 6)::double as score from s order by round(score, 6) desc, a, b limit 50")
def graph_top_paths(spark, d):
    return graph_path_score(spark, d).orderBy(F.col("score").desc(), "a", "b").limit(50)


@query("edge_prefilter_topn", EDGES + " select a, b, round(weight, 6) as weight from e order by 3 desc, 1, 2 limit 8000")
def edge_prefilter_topn(spark, d):
    return graph_edges(spark, d).select("a", "b", "weight").orderBy(F.col("weight").desc(), "a", "b").limit(8000)


_ORDER = " ".join(f"when '{k}' then {i}" for i, k in enumerate(graph.TYPE_SHARES))
_CAPS = " ".join(f"when '{k}' then {max(1, int(v * 100))}" for k, v in graph.TYPE_SHARES.items())


@query("path_stratified_sample", SCORED + f""", r as (select a, b, bridge, kind, round(score, 6)::double as score, row_number() over (partition by kind order by round(score, 6) desc, a, b) as rk from s),
l as (select *, rk > case kind {_CAPS} end as late, case kind {_ORDER} end as o from r where rk <= 100)
select a, b, bridge, kind, score from l order by late, case when late then 0 else o end, score desc, a, b limit 100""")
def path_stratified_sample(spark, d):
    p = _scored(spark, d).select("a", "b", "bridge", "kind", F.round("score", 6).alias("score"))
    return graph.stratified(p, graph.TYPE_SHARES, 100)


@query("graph_2hop_capped", EDGES + " select a, b from (select a, b, row_number() over (partition by a order by round(weight, 6) desc, b) as k from e) where k <= 100")
def graph_2hop_capped(spark, d):
    return graph.pairs_capped(_edges(spark, d))


HOPS = EDGES + """, u as (select a, b, round(weight, 6) as w, shared from e union all select b, a, round(weight, 6), shared from e), r as (select *, row_number() over (partition by a order by w desc, b) as k from u),
h as (select distinct least(x.a, y.b) as a, x.b as m, greatest(x.a, y.b) as b from r x join r y on x.b = y.a where x.k <= 4 and y.k <= 4 and x.a <> y.b), t as (select * from h where not exists (select 1 from e where e.a = h.a and e.b = h.b))"""


@query("graph_3hop", HOPS + " select a, m, b from t")
def graph_3hop(spark, d):
    return graph.two_hops(_edges(spark, d).select("a", "b", "weight"), 4, 4)


@query("graph_3hop_paths", HOPS + f""", {FEATURES}, j as (select t.*, round(x.w + y.w, 6) as weight, list_distinct(list_concat(x.shared, y.shared)) as shared from t join u x on x.a = t.a and x.b = t.m join u y on y.a = t.m and y.b = t.b),
top as (select * from j where len(shared) > 0 order by weight desc, a, m, b limit 50), g as (select top.*, idf.entity, idf, row_number() over (partition by top.a, m, top.b order by idf desc, idf.entity) as k from top, unnest(shared) as z(x) join idf on idf.entity = z.x)
select g.a, g.m, g.b, g.entity as bridge, array_to_string(list_sort(shared), ',') as shared, round(greatest(0, least(1, 0.45 * case when idf / (select max(idf) from idf) between 0.2 and 0.9 then 1 else 0.5 end + 0.25 * case when g.entity in (p.title, q.title, v.title) then 0.4 else 1 end + 0.15 * case when greatest(p.words, q.words, v.words) > 0 then least(p.words, q.words, v.words) / greatest(p.words, q.words, v.words) else 0 end + 0.15 * least(1, len(shared) / 4))), 6)::double as score, weight
from g join w p on p.doc = g.a join w q on q.doc = g.m join w v on v.doc = g.b where k = 1""")
def graph_3hop_paths(spark, d):
    posts, idf = _idf(spark, d)
    idf = stash(idf, "idf")
    e = stash(graph.edges(posts, idf, graph.direct_links(_named(spark, d))), "edges")
    top = idf.agg(F.max("idf")).first()[0] or 1.0
    p = graph.three_document_paths(e, graph.features(_named(spark, d)), idf, top, 50)
    return p.select("a", "m", "b", "bridge", F.array_join("shared", ",").alias("shared"), F.round("score", 6).alias("score"), "weight")


SEEDS = ["the thing", "Nicht anders", "Dans la maison", "ation ment"]
_WORDS = LIST(corpus.seed_tokens(SEEDS))
RANKED = f"""with ti as (select page_id as doc, {TITLE} as title from pages), posts as ({POSTS}), pos as (select page_id as doc, list_transform({HREFS}, lambda h: trim(lower(url_decode(h)))) as raw from pages),
tg as (select doc, list_filter(list_distinct(raw), lambda h: h <> '' and not contains(h, '#')) as l from pos), ov as (select doc, count(own.title) / count(*) as overlap, count(*) as n from posts left join (select distinct title from ti) own on entity = own.title group by 1),
first as (select doc, entity, min(list_position(raw, entity)) as p from posts join pos using (doc) group by 1, 2), fl as (select doc, list(entity order by p) as l from first group by 1),
sc as (select doc as page_id, round(overlap, 6) as overlap, round(2.0 * overlap + 0.10 * (len(list_filter(list_slice(fl.l, 1, 40), lambda x: len(list_filter({_WORDS}, lambda s: contains(x, s))) > 0)) + 3 * len(list_filter({_WORDS}, lambda s: contains(title, s)))) + 0.02 * least(n, 60) + case when overlap >= 0.5 then 1 else 0 end, 6)::double as score from ov join fl using (doc) join ti using (doc))"""


@query("corpus_rank_score", RANKED + " select page_id, overlap, score from sc")
def corpus_rank_score(spark, d):
    return corpus.rank_score(_named(spark, d), SEEDS)


@query("corpus_degree_topn", RANKED + f""", pre as (select page_id, row_number() over (order by score desc, page_id) as pos from (select * from sc order by score desc, page_id limit 120)), tt as (select distinct title from ti join pre on doc = page_id),
lk as (select distinct page_id, entity from (select doc as page_id, unnest(raw) as entity from pos) join pre using (page_id) join tt on entity = title), ok as (select entity from lk group by 1 having count(*) between 2 and 400), dg as (select page_id, count(*) as degree from lk join ok using (entity) group by 1),
pick as (select page_id, pos, coalesce(degree, 0) as degree from pre left join dg using (page_id) order by degree desc, pos limit 80)
select printf('doc_%06d', row_number() over (order by degree desc, pos) - 1) as doc_id, page_id, cast(degree as bigint) as degree from pick""")
def corpus_degree_topn(spark, d):
    a = _named(spark, d)
    got = corpus.select(corpus.best_ranked(a, corpus.rank_score(a, SEEDS), 80), 80)
    return got.select(F.format_string("doc_%06d", "seq").alias("doc_id"), "page_id", "degree")


@query("corpus_documents", f"with a as (select page_id, {TITLE} as title, url, regexp_replace(html, '<[^>]*>', ' ', 'g') as t, {HREFS} as h from pages) select printf('doc_%06d', page_id) as doc_id, page_id as source_id, title, url, 'en' as language, cast(len(list_filter(list_transform(h, lambda x: trim(lower(url_decode(x)))), lambda x: x <> '' and not contains(x, '#'))) as bigint) as n_links, cast(length(t) as bigint) as char_count, cast(len(" + WORDS.format("t") + ") as bigint) as word_count from a")
def corpus_documents(spark, d):
    return corpus.documents(_named(spark, d), F.col("page_id")).select("doc_id", "source_id", "title", "url", "language", F.size("links").cast("long").alias("n_links"), "char_count", "word_count")


def _docs(spark, d) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").alias("doc"), "text")


TF = "t as (select doc_id as doc, unnest(" + TOK.format("text") + ") as term from documents), n as (select count(*) as n from documents)"


@query("bm25_idf_terms", f"with {TF}, f as (select term, count(distinct doc) as df from t group by 1) select term, cast(df as bigint) as df, round(ln(((select n from n) - df + 0.5) / (df + 0.5) + 1), 6) as idf from f")
def bm25_idf_terms(spark, d):
    docs = _docs(spark, d)
    return retrieval.term_weights(retrieval.term_counts(docs), docs.count()).select("term", "df", F.round("idf", 6).alias("idf"))


BM25 = f"""with {TF}, l as (select doc_id as doc, len({TOK.format('text')}) as dl from documents), m as (select avg(dl) as m from l),
q as (select item_id as query, term, count(*) as qf from (select item_id, unnest({TOK.format('text')}) as term from benchmark) group by 1, 2),
c as (select doc, term, count(*) as tf from t where term in (select term from q) group by 1, 2), f as (select term, count(*) as df from c group by 1),
i as (select term, ln(((select n from n) - df + 0.5) / (df + 0.5) + 1) as idf from f),
s as (select query, doc, round(sum(qf * idf * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * dl / (select m from m)))), 6) as score from c join l using (doc) join i using (term) join q using (term) group by 1, 2),
r as (select query, doc, score, row_number() over (partition by query order by score desc, doc) as rank from s)"""


def _bm25(spark, d) -> DataFrame:
    q = table(spark, d, "benchmark").select(F.col("item_id").alias("query"), "text")
    return retrieval.bm25(_docs(spark, d), q, 10)


@query("bm25_topk", BM25 + " select query, doc, score, cast(rank as int) as rank from r where rank <= 10")
def bm25_topk(spark, d):
    return _bm25(spark, d)


def _gold(spark, d) -> DataFrame:
    """(query, doc): documents that hold a passage; its first five words are the key of the join."""
    b = table(spark, d, "benchmark").select(F.col("item_id").alias("query"), F.col("text").alias("passage"))
    five = lambda t: F.split(F.btrim(t), r"\s+")
    key = b.withColumn("k", F.array_join(F.slice(five(F.col("passage")), 1, 5), " "))
    rows = _docs(spark, d).withColumn("w", five(F.col("text")))
    grams = rows.select("doc", F.explode(F.array_distinct(F.transform("w", lambda _, i: F.array_join(F.slice(F.col("w"), i + 1, F.lit(5)), " ")))).alias("k"))
    maybe = grams.join(key.select("query", "k"), "k").select("doc", "query").distinct()
    return maybe.join(_docs(spark, d), "doc").join(b, "query").filter(F.contains(F.col("text"), F.col("passage"))).select("query", "doc")


GOLD = "gold as (select item_id as query, doc_id as doc, case when doc_id % 2 = 0 then 3 else 2 end as grade from benchmark b join documents d on contains(d.text, b.text))"


@query("bm25_recall_mrr", BM25 + f""", {GOLD}, per as (select query, coalesce(max(1 / rank), 0) as rr, count(rank) / count(*) as recall, count(rank) filter (grade = 3) / nullif(count(*) filter (grade = 3), 0) as g3 from gold left join (select * from r where rank <= 10) using (query, doc) group by 1)
select count(*) as n, round(coalesce(avg(rr), 0), 6) as mrr, round(coalesce(avg(recall), 0), 6) as recall, round(coalesce(avg(g3), 0), 6) as g3_recall from per""")
def bm25_recall_mrr(spark, d):
    gold = _gold(spark, d).withColumn("grade", F.when(F.col("doc") % 2 == 0, 3).otherwise(2))
    return retrieval.measures(_bm25(spark, d), gold)


DOT = "list_dot_product(x.embedding::double[], y.embedding::double[])"
DENSE = f"s as (select x.vec_id as query, y.vec_id as doc, round({DOT}, 6) as score from embeddings x join embeddings y on x.vec_id % 100 = 0 and x.vec_id <> y.vec_id), r as (select *, row_number() over (partition by query order by score desc, doc) as rank from s)"


def _dense(spark, d, k: int = 10) -> DataFrame:
    """The stated query set: every vector whose id is divisible by 100, against all rows."""
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    return similarity.vector_topk(v.filter("id % 100 = 0"), v, k)


@query("dense_topk", f"with {DENSE} select query, doc, score, cast(rank as int) as rank from r where rank <= 10")
def dense_topk(spark, d):
    return _dense(spark, d)


@query("dense_label_recall", f"with {DENSE} select query, round(avg(case when x.label = y.label then 1.0 else 0.0 end), 6) as precision from r join embeddings x on x.vec_id = query join embeddings y on y.vec_id = doc where rank <= 10 group by 1")
def dense_label_recall(spark, d):
    v = table(spark, d, "embeddings")
    hit = _dense(spark, d).join(v.select(F.col("vec_id").alias("query"), F.col("label").alias("lx")), "query").join(v.select(F.col("vec_id").alias("doc"), F.col("label").alias("ly")), "doc")
    return hit.groupBy("query").agg(F.round(F.avg(F.when(F.col("lx") == F.col("ly"), 1.0).otherwise(0.0)), 6).alias("precision"))


@query("dense_best_match", f"with {DENSE} select query, doc, score from r where rank = 1")
def dense_best_match(spark, d):
    return _dense(spark, d, 1).select("query", "doc", "score")


@query("vector_block_topk", f"with {DENSE} select query, doc, score, cast(rank as int) as rank from r where rank <= 5")
def vector_block_topk(spark, d):
    """The same search in small blocks of rows, whose best are merged."""
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    return similarity.vector_topk(v.filter("id % 100 = 0"), v, 5, 64)


@query("cosine_pairs", f"select x.vec_id as a, y.vec_id as b, round({DOT}, 6) as similarity from embeddings x join embeddings y on x.vec_id < y.vec_id where round({DOT}, 6) >= 0.4")
def cosine_pairs(spark, d):
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    return similarity.cosine_pairs(v, 0.4)


SETS = f"sets as (select doc_id, list_sort(list_filter(list_distinct({TOK.format('text')}), lambda w: not list_contains({STOPS}, w))) as s from documents), cl as (select *, min(doc_id) over (partition by s) as rep from sets where len(s) > 0), one as (select doc_id, s, len(s) as n from cl where doc_id = rep), jp as (select x.doc_id as a, y.doc_id as b from one x join one y on x.doc_id < y.doc_id and x.n >= 0.85 * y.n - 1e-9 and y.n >= 0.85 * x.n - 1e-9 where len(list_intersect(x.s, y.s)) / (x.n + y.n - len(list_intersect(x.s, y.s))) >= 0.85)"


def _jaccard(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, classes, pairs of class representatives)."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    return docs, *similarity.jaccard_pairs(docs, 0.85)


@query("jaccard_pairs", f"with {SETS}, l as (select a as rep, count(*) as k from (select a from jp union all select b from jp) group by 1) select doc_id, coalesce(rep, doc_id) as class_id, cast(coalesce(k, 0) as bigint) as n_links from sets left join cl using (doc_id) left join l using (rep)")
def jaccard_pairs(spark, d):
    """One row per document: its class and the number of its links to other classes."""
    docs, classes, pairs = _jaccard(spark, d)
    bare = docs.filter(~F.coalesce(F.size(tx.content_set(F.col("text"))) > 0, F.lit(False)))  # no content token: a class of its own
    classes = classes.union(bare.select("id", F.col("id").alias("rep")))
    links = pairs.select("a").union(pairs.select("b")).groupBy(F.col("a").alias("rep")).agg(F.count(F.lit(1)).alias("links"))
    return classes.join(links, "rep", "left").select(F.col("id").alias("doc_id"), F.col("rep").alias("class_id"), F.coalesce("links", F.lit(0).cast("long")).alias("n_links"))


@query("jaccard_greedy_keep", f"""with recursive {SETS}, nb as (select b as id, list(a) as before from jp group by 1), o as materialized (select id, before, row_number() over (order by id) as k from nb),
g(k, gone) as (select 0::bigint, []::bigint[] union all select o.k, case when len(list_filter(o.before, lambda x: not list_contains(g.gone, x))) > 0 then list_append(g.gone, o.id) else g.gone end from g join o on o.k = g.k + 1)
select doc_id from sets left join cl using (doc_id) where (rep is null or rep = doc_id) and not list_contains((select gone from g order by k desc limit 1), doc_id)""")
def jaccard_greedy_keep(spark, d):
    """The documents that a scan by id keeps. Of equal sets only the first can stay; a document without a token always does."""
    docs, classes, pairs = _jaccard(spark, d)
    first = docs.select("id").join(classes.filter("id <> rep").select("id"), "id", "left_anti")
    return similarity.greedy_keep(first, pairs).select(F.col("id").alias("doc_id"))


@query("cosine_cluster_keep")
def cosine_cluster_keep(spark, d):
    """Vectors that remain of clusters at .4, scored by a number of their label; held against a scan in the tests."""
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), (F.col("label") % 3).cast("double").alias("score"))
    return similarity.vector_cluster_keep(v, 0.4).select(F.col("id").alias("vec_id"))


@query("token_bag_regex_features", rf"select doc_id, cast(len({TOK.format('text')}) as bigint) as n_tokens, cast(len(list_distinct({TOK.format('text')})) as bigint) as n_distinct, cast(len(list_distinct(regexp_extract_all(substr(text, 1, 2000), '\b(1[0-9]{{3}}|20[0-9]{{2}})\b', 1))) as bigint) as n_years from documents")
def token_bag_regex_features(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.size(tx.tokens(t)).cast("long").alias("n_tokens"), F.size(F.array_distinct(tx.tokens(t))).cast("long").alias("n_distinct"), F.size(F.array_distinct(F.regexp_extract_all(F.substring(t, 1, 2000), F.lit(r"\b(1[0-9]{3}|20[0-9]{2})\b"), F.lit(1)))).cast("long").alias("n_years"))


@query("token_array_setops", f"select doc_id, cast(len(list_filter({TOK.format('text')}, lambda w: not list_contains({STOPS}, w))) as bigint) as n_content, cast(len(list_filter(list_distinct({TOK.format('text')}), lambda w: not list_contains({STOPS}, w))) as bigint) as n_set from documents")
def token_array_setops(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(tx.content_tokens(F.col("text"))).cast("long").alias("n_content"), F.size(tx.content_set(F.col("text"))).cast("long").alias("n_set"))


@query("embed_text_prefix", "select doc_id, substr(coalesce(text, ''), 1, 2000) as head from documents")
def embed_text_prefix(spark, d):
    return table(spark, d, "documents").select("doc_id", F.substring(tx.text(F.col("text")), 1, 2000).alias("head"))


TURNS = "a as (select conv_id, turn, role, text, lead(text) over (partition by conv_id order by turn) as answer, lead(role) over (partition by conv_id order by turn) as next from conversations), r as (select conv_id, turn, text as question, answer, array_to_string(list_slice(regexp_split_to_array(trim(answer), '\\s+'), 1, 3), ' ') as short from a where role = 'user' and next = 'assistant')"


def _records(spark, d) -> DataFrame:
    """User turns with the assistant's answer; the short answer is its first three words."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(spark, d, "conversations").withColumn("answer", F.lead("text").over(w)).withColumn("next", F.lead("role").over(w))
    r = c.filter("role = 'user' and next = 'assistant'")
    return r.select("conv_id", "turn", F.col("text").alias("question"), "answer", F.array_join(F.slice(F.split(F.btrim("answer"), r"\s+"), 1, 3), " ").alias("short"))


N = "len(" + WORDS + ")"


@query("heuristic_score", f"with {TURNS} select conv_id, turn, round(least(1.0, case when {N.format('question')} between 8 and 60 then 0.2 else 0 end + case when trim(question) like '%?' then 0.1 else 0 end + case when {N.format('short')} between 1 and 6 then 0.2 else 0 end + case when {N.format('answer')} between 40 and 150 then 0.2 else 0 end + case when trim(answer) <> '' then 0.1 else 0 end + case when len(list_distinct(regexp_extract_all(answer, '\\(Document\\s+[A-Z0-9]+\\)'))) >= 2 then 0.2 else 0 end), 6)::double as score from r".replace("\\\\", "\\"))
def heuristic_score(spark, d):
    return _records(spark, d).select("conv_id", "turn", F.round(funnel.heuristic_score(F.col("question"), F.col("short"), F.col("answer"), F.col("answer")), 6).alias("score"))


@query("token_overlap_leakage", f"with {TURNS}, q as (select conv_id, turn, list_filter({TOK.format('question')}, lambda w: not list_contains({STOPS}, w)) as q, {TOK.format('answer')} as c from r) select conv_id, turn, round(case when len(q) > 0 then len(list_filter(q, lambda w: list_contains(c, w))) / len(q) else 0 end, 6)::double as leakage from q")
def token_overlap_leakage(spark, d):
    return _records(spark, d).select("conv_id", "turn", F.round(tx.overlap_fraction(F.col("question"), F.col("answer")), 6).alias("leakage"))


@query("length_histograms", "with x as (select doc_id, len(" + WORDS.format("text") + ") as n from documents) select cast(count(*) filter (n < 8) as bigint) as b0, cast(count(*) filter (n >= 8 and n < 60) as bigint) as b8, cast(count(*) filter (n >= 60 and n < 200) as bigint) as b60, cast(count(*) filter (n >= 200) as bigint) as b200, round(avg(n), 2) as mean from x")
def length_histograms(spark, d):
    n = tx.word_count(F.col("text"))
    x = table(spark, d, "documents").select(n.alias("n"))
    return x.agg(*[F.count_if(F.expr(c)).alias(a) for c, a in (("n < 8", "b0"), ("n >= 8 and n < 60", "b8"), ("n >= 60 and n < 200", "b60"), ("n >= 200", "b200"))], F.round(F.avg("n"), 2).alias("mean"))


@query("json_props_extract", "select event_id, try_cast(json_extract_string(props, '$.k') as bigint) as k from events")
def json_props_extract(spark, d):
    return table(spark, d, "events").select("event_id", F.expr("try_cast(get_json_object(props, '$.k') as bigint)").alias("k"))


@query("resume_antijoin", "select conv_id, cast(i as int) as candidate from (select distinct conv_id from conversations) cross join range(4) t(i) where not exists (select 1 from conversations c where c.conv_id = conversations.conv_id and c.turn = i and c.role = 'assistant')".replace("(select distinct conv_id from conversations) cross", "(select distinct conv_id from conversations) conversations cross"))
def resume_antijoin(spark, d):
    c = table(spark, d, "conversations")
    jobs = c.select("conv_id").distinct().select("conv_id", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("candidate"))
    return funnel.pending(jobs, c.filter("role = 'assistant'").select("conv_id", F.col("turn").cast("int").alias("candidate")), ["conv_id", "candidate"])


def _turns(spark, d) -> DataFrame:
    """The turns of a conversation as the chunks of a document."""
    return table(spark, d, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("idx"), F.col("text").alias("chunk_text"))


@query("chunk_hints", """with e as (select conv_id as doc, lower(split_part(trim(text), ' ', 1)) as entity from conversations where role = 'user' group by all),
c as (select doc, entity, turn as idx, not contains(lower(coalesce(text, '')), entity) as miss from conversations join e on conv_id = doc),
k as (select *, row_number() over (partition by doc, entity order by miss, idx) as k, bool_and(miss) over (partition by doc, entity) as none from c) select doc, entity, idx from k where k <= 3 and (none or not miss)""")
def chunk_hints(spark, d):
    first = F.lower(F.split_part(F.btrim("text"), F.lit(" "), F.lit(1)))
    e = table(spark, d, "conversations").filter("role = 'user'").select(F.col("conv_id").alias("doc"), first.alias("entity")).distinct()
    return passages.hints(_turns(spark, d), e)


@query("leading_text", """with c as (select conv_id as doc, turn, coalesce(text, '') as t, coalesce(sum(length(coalesce(text, ''))) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding), 0) as before from conversations)
select doc, string_agg(t, chr(10) order by turn) as text, count(*) as n_chunks from c where before < 6000 group by 1""")
def leading_text(spark, d):
    return passages.leading_text(_turns(spark, d))


@query("span_map", f"""with {TURNS}, s as (select distinct conv_id as doc, turn as id, regexp_replace(trim(short), '^["'']+|["'']+$', '', 'g') as span from r where short <> ''),
h as (select s.id, s.doc, c.turn as idx, instr(coalesce(c.text, ''), span) - 1 as start, span, row_number() over (partition by s.id, s.doc, span order by c.turn) as k from s join conversations c on c.conv_id = s.doc and contains(coalesce(c.text, ''), span))
select id, doc, idx, cast(start as int) as start, cast(start + length(span) as int) as "end" from h where k = 1""")
def span_map(spark, d):
    s = _records(spark, d).select(F.col("conv_id").alias("doc"), F.col("turn").alias("id"), F.col("short").alias("span"))
    return passages.map_spans(s, _turns(spark, d))
