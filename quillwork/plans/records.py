"""Queries over question records, their judges and their final form; conversations stand for generated records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import evaluation, funnel, passages, retrieval, similarity
from ..sources.files import reference_sample
from ..sources.scratch import scratch, stash
from ..sources.tables import table
from .catalogue import BM25, GOLD, STOPS, TOK, TURNS, WORDS, _bm25, _gold, _records
from .registry import query

N = "len(" + WORDS + ")"
LIST = lambda v: "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in v) + "]"
STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
LETTER = r"'^[\p{{L}}\p{{N}}_]$'".replace("{{", "{").replace("}}", "}")
#: Whether want stands in low with borders of words; both are SQL expressions.
BOUNDED = f"({{w}} <> '' and contains({{l}}, {{w}}) and len(list_filter(range(1, length({{l}}) + 1), lambda i: substr({{l}}, i, length({{w}})) = {{w}} and (i > 1 and regexp_matches(substr({{l}}, i - 1, 1), L)) <> regexp_matches(substr({{w}}, 1, 1), L) and regexp_matches(substr({{l}}, i + length({{w}}), 1), L) <> regexp_matches(right({{w}}, 1), L))) > 0)".replace(", L)", f", {LETTER.replace('{', '{{').replace('}', '}}')})")
CITED = r"len(list_distinct(regexp_extract_all({}, '\(Document\s+[A-Z0-9]+\)')))"


def bounded(low: str, want: str) -> str:
    return BOUNDED.format(l=low, w=want)


HEURISTIC = f"round(least(1.0, case when {N.format('{q}')} between 8 and 60 then 0.2 else 0 end + case when {STRIP.format('{q}')} like '%?' then 0.1 else 0 end + case when {N.format('{s}')} between 1 and 6 then 0.2 else 0 end + case when {N.format('{l}')} between 40 and 150 then 0.2 else 0 end + case when {STRIP.format('{l}')} <> '' then 0.1 else 0 end + case when {CITED.format('{l}')} >= 2 then 0.2 else 0 end), 6)::double"


def heuristic_sql(q: str, s: str, long: str) -> str:
    return HEURISTIC.replace("{q}", q).replace("{s}", s).replace("{l}", long)


KIND = rf"""case when s = '' then 'empty' when regexp_matches(s, '^-?\d+(\.\d+)?$') then 'numeric' when regexp_matches(s, '(?i)^({tx.MONTHS})\s+\d+') then 'date' when regexp_matches(s, '^\d{{1,4}}[/-]\d{{1,4}}([/-]\d{{2,4}})?$') then 'date'
when lower(s) in ('yes', 'no', 'true', 'false') then 'boolean' when len(regexp_split_to_array(s, '\s+')) <= 3 and len(list_filter(regexp_split_to_array(s, '\s+'), lambda w: substr(w, 1, 1) <> upper(substr(w, 1, 1)) or substr(w, 1, 1) = lower(substr(w, 1, 1)))) = 0 then 'entity' else 'phrase' end"""


@query("answer_type_share", f"with {TURNS}, k as (select {KIND} as kind from (select {STRIP.format('short')} as s from r)) select kind, count(*) as n, round(count(*) / sum(count(*)) over (), 4) as share from k group by 1")
def answer_type_share(spark, d):
    g = _records(spark, d).groupBy(tx.answer_type(F.col("short")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return g.select("kind", "n", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 4).alias("share"))


_LOW = f"lower({STRIP.format('question')})"
_WANT = f"lower({STRIP.format('short')})"
_Q = f"list_filter({TOK.format('question')}, lambda w: not list_contains({STOPS}, w))"
LEAKAGE = f"case when len({_Q}) > 0 then len(list_filter({_Q}, lambda w: list_contains({TOK.format('answer')}, w))) / len({_Q}) else 0 end"
REASONS = f"""x as (select [case when len({TOK.format('question')}) < 8 then 'short_question' end, case when {_WANT} in ({LIST(tx.PRONOUN_ANSWERS)[1:-1]}) then 'pronoun_answer' end, case when {_WANT} = '' then 'empty_short_answer' end, case when {bounded(_LOW, _WANT)} then 'answer_in_question' end, case when {CITED.format('answer')} < 2 then 'insufficient_citations' end, case when {LEAKAGE} > 0.8 then 'lexical_leakage' end] as rej,
[case when len({TOK.format('question')}) > 60 then 'long_question' end, case when {STRIP.format('question')} not like '%?' then 'no_qmark' end, case when len(list_filter({LIST(tx.QUESTION_OPENINGS)}, lambda o: starts_with({_LOW}, o))) = 0 then 'nonstd_qword' end, case when {N.format('short')} > 8 then 'long_short_answer' end, case when {N.format('answer')} < 40 then 'short_long_answer' end, case when {N.format('answer')} > 150 then 'too_long_long_answer' end] as fl from r)"""


@query("filter_battery_reasons", f"with {TURNS}, {REASONS} select kind, reason, count(*) as n from (select 'reject' as kind, unnest(rej) as reason from x union all select 'flag', unnest(fl) from x) where reason is not null group by 1, 2")
def filter_battery_reasons(spark, d):
    r = _records(spark, d)
    reject, flag = funnel.filter_reasons(F.col("question"), F.col("short"), F.col("answer"), tx.overlap_fraction(F.col("question"), F.col("answer")))
    both = r.select(F.explode(F.concat(F.transform(reject, lambda x: F.struct(F.lit("reject").alias("kind"), x.alias("reason"))), F.transform(flag, lambda x: F.struct(F.lit("flag").alias("kind"), x.alias("reason"))))).alias("x"))
    return both.groupBy("x.kind", "x.reason").agg(F.count(F.lit(1)).alias("n"))


@query("max_leakage", f"with {TURNS}, j as (select r.conv_id * 1000 + r.turn as id, case when len(q) > 0 then len(list_filter(q, lambda w: list_contains({TOK.format('c.text')}, w))) / len(q) else 0 end as l from (select *, {_Q} as q from r) r join conversations c using (conv_id) where c.turn <> r.turn) select id, round(max(l), 6)::double as leakage from j group by 1")
def max_leakage(spark, d):
    """A question against the other turns of its conversation as chunks of its document."""
    r = _records(spark, d).select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "question", "conv_id", "turn")
    c = table(spark, d, "conversations").join(r.select("id", "conv_id", F.col("turn").alias("own")), "conv_id").filter("turn <> own").select(F.col("id").alias("doc"), F.col("text").alias("chunk_text"))
    return funnel.most_leakage(r.select("id", "question", F.array("id").alias("docs")), c)


RECORD = "query string, short_answer string, bridge_entity string, spans array<struct<doc:bigint,spans:array<string>>>"
_BRIDGE = "array_to_string(list_slice(regexp_split_to_array(trim(question), '\\s+'), 2, 2), ' ')"


@query("qg_validate", f"""with {TURNS}, x as (select conv_id * 1000 + turn as id, case when turn % 5 = 4 then ['schema_invalid'] else list_filter([case when {STRIP.format('question')} not like '%?' or {N.format('question')} < 5 then 'bad_question' end, case when {_WANT} in ({LIST(funnel.BARE_ANSWERS)[1:-1]}) then 'pronoun_answer' end, case when {bounded(_LOW, _WANT)} then 'answer_in_question' end,
case when length({_BRIDGE}) >= 4 and contains({_LOW}, lower({_BRIDGE})) then 'bridge_in_question' end, case when conv_id % 7 = 3 then 'unknown_doc:' || (conv_id + 100000) when conv_id % 5 = 1 then 'span_not_in_doc' end], lambda f: f is not null) end as flags from r) select id, len(flags) = 0 as valid, array_to_string(flags, ',') as flags from x""")
def qg_validate(spark, d):
    """Records as a model's answers: JSON in fences or among words, read leniently and judged against their documents."""
    r = _records(spark, d).withColumn("id", F.col("conv_id") * 1000 + F.col("turn"))
    doc = F.when(F.col("conv_id") % 7 == 3, F.col("conv_id") + 100000).otherwise(F.col("conv_id"))
    quoted = F.concat(F.array(F.substring("answer", 1, 40)), F.when(F.col("conv_id") % 5 == 1, F.array(F.lit("zz yy xx"))).otherwise(F.array().cast("array<string>")))
    spans = F.array(F.struct(doc.alias("doc"), quoted.alias("spans")))
    made = F.to_json(F.struct(F.col("question").alias("query"), F.when(F.col("turn") % 5 != 4, F.col("short")).alias("short_answer"), F.array_join(F.slice(F.split(F.btrim("question"), r"\s+"), 2, 1), " ").alias("bridge_entity"), spans.alias("spans")))
    raw = F.when(F.col("turn") % 4 == 0, F.concat(F.lit("```json\n"), made, F.lit("\n```"))).otherwise(F.concat(F.lit("Sure: "), made, F.lit(" .")))
    j = r.select("id", tx.lenient_json(raw, RECORD).alias("j")).select("id", "j.*")
    complete = F.col("query").isNotNull() & F.col("short_answer").isNotNull() & F.col("bridge_entity").isNotNull() & F.col("spans").isNotNull()
    docs = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "\n").alias("text")).select(F.col("conv_id").alias("doc"), "text")
    got = funnel.validate(j.select("id", complete.alias("complete"), "query", F.col("short_answer").alias("short"), F.col("bridge_entity").alias("bridge"), "spans"), docs)
    return got.select("id", "valid", F.array_join("flags", ",").alias("flags"))


def _candidates(spark, d) -> tuple[DataFrame, DataFrame]:
    """(candidates, verdicts): an assistant's turns as the candidates of their conversation."""
    c = table(spark, d, "conversations").filter("role = 'assistant'")
    head = F.array_join(F.slice(F.split(F.btrim("text"), r"\s+"), 1, 3), " ")
    cand = c.select(F.col("conv_id").alias("path"), F.col("turn").alias("idx"), (F.col("turn") % 6 != 5).alias("valid"), F.round(funnel.heuristic_score(head, head, F.col("text"), F.col("text")), 6).alias("heuristic"))
    k = F.col("conv_id") % 4
    verdict = table(spark, d, "conversations").select("conv_id").distinct().filter("conv_id % 11 <> 7").select(F.col("conv_id").alias("path"), F.when(k == 0, 0).when(k == 1, -1).when(k == 2, 1).alias("best_index"), (k == 3).alias("failed"))
    return cand, verdict


_HEAD = "array_to_string(list_slice(regexp_split_to_array(trim(text), '\\s+'), 1, 3), ' ')"
CANDIDATES = f"""c as (select *, row_number() over (partition by path order by idx) - 1 as place, count(*) over (partition by path) as n from (select conv_id as path, turn as idx, {heuristic_sql(_HEAD, _HEAD, 'text')} as h from conversations where role = 'assistant' and turn % 6 <> 5)),
v as (select *, case when path % 11 = 7 then null when path % 4 = 0 then 0 when path % 4 = 1 then -1 when path % 4 = 2 then 1 end as best, path % 11 <> 7 and path % 4 = 3 as failed from c),
z as (select *, coalesce(not failed and best between 0 and n - 1, false) as named from v), y as (select *, case when n = 1 then 0.65 when failed then 0.55 when named then 0.80 else 0.35 end as judge, row_number() over (partition by path order by case when n = 1 or (named and best = place) then 0 else 1 end, h desc, place) as k from z)"""


@query("judge_blend_best_of_n", f"with {CANDIDATES} select path, idx, h as heuristic, judge::double as judge, round(0.7 * judge + 0.3 * h, 6)::double as final from y where k = 1")
def judge_blend_best_of_n(spark, d):
    best = funnel.best_of(*_candidates(spark, d))
    return best.select("path", "idx", "heuristic", "judge", F.round("final", 6).alias("final"))


@query("union_winners", f"with {CANDIDATES} select path, idx, n = 1 as single from y where k = 1")
def union_winners(spark, d):
    return funnel.winners(*_candidates(spark, d))


@query("candidate_groups", f"with {CANDIDATES} select path, count(*) as n, array_to_string(list(idx order by idx), ',') as members from c where path in (select doc_id from documents) group by 1")
def candidate_groups(spark, d):
    """Valid candidates by path, of the paths whose document is known."""
    known = table(spark, d, "documents").select(F.col("doc_id").alias("path")).distinct()
    g = funnel.groups(_candidates(spark, d)[0]).join(known, "path", "left_semi")
    return g.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list("idx")), lambda x: x.cast("string")), ",").alias("members"))


_RESULTS = "res as (select conv_id as path, role = 'assistant' and turn % 5 = 1 as solvable, case turn % 4 when 0 then 'high' when 1 then 'Medium' when 2 then 'low' else null end as confidence, turn, count(*) over (partition by conv_id) + case when conv_id % 3 = 0 then 1 else 0 end as expected from conversations)"
_DECIDED = "select path, case when count(*) filter (solvable) = 0 then 'pass' when count(*) filter (solvable) = 1 then 'reject_single_hop' else 'reject_trivial' end as decision, case when count(*) filter (solvable) = 0 then round(avg(case lower(coalesce(confidence, 'medium')) when 'high' then 1.0 when 'medium' then 0.7 when 'low' then 0.4 else 0.5 end), 6)::double else 0 end as confidence"


def _results(spark, d) -> DataFrame:
    """A judgement of each turn: path, doc, expected, solvable, confidence; a third of the paths miss one."""
    c = table(spark, d, "conversations")
    k = F.col("turn") % 4
    n = F.count(F.lit(1)).over(Window.partitionBy("conv_id")) + F.when(F.col("conv_id") % 3 == 0, 1).otherwise(0)
    return c.select(F.col("conv_id").alias("path"), F.col("turn").cast("string").alias("doc"), n.cast("int").alias("expected"), ((F.col("role") == "assistant") & (F.col("turn") % 5 == 1)).alias("solvable"), F.when(k == 0, "high").when(k == 1, "Medium").when(k == 2, "low").alias("confidence"))


@query("solvability_decide", f"with {_RESULTS} {_DECIDED} from res group by 1")
def solvability_decide(spark, d):
    return funnel.decide(_results(spark, d).select("path", "solvable", "confidence"))


@query("decision_counts", f"with {_RESULTS}, x as ({_DECIDED} from res group by 1) select decision, count(*) as n from x group by 1")
def decision_counts(spark, d):
    return solvability_decide(spark, d).groupBy("decision").agg(F.count(F.lit(1)).alias("n"))


@query("completed_groups", f"with {_RESULTS}, x as ({_DECIDED}, count(*) as n, max(expected) as expected from res group by 1) select path::varchar as path, n, decision, confidence from x where n >= expected")
def completed_groups(spark, d):
    from ..streaming.groups import completed

    return completed(_results(spark, d).withColumn("path", F.col("path").cast("string")))


@query("stream_group_complete", f"with {_RESULTS}, x as ({_DECIDED}, count(*) as n, max(expected) as expected from res group by 1) select path::varchar as path, n, decision, confidence from x where n >= expected")
def stream_group_complete(spark, d):
    """The same from a stream: results written as JSON lines, read back file by file, emitted once a path is complete."""
    from ..streaming.groups import RESULT, complete_groups, lines

    base = scratch(spark)
    _results(spark, d).withColumn("path", F.col("path").cast("string")).repartition(3, "doc").write.json(f"{base}/in")
    done = complete_groups(lines(spark, f"{base}/in", RESULT, 1)).writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    done.awaitTermination()
    got = spark.read.schema("path string, docs array<string>, solvable array<boolean>, confidences array<string>").parquet(f"{base}/out")
    each = got.select("path", F.explode(F.arrays_zip("docs", "solvable", "confidences")).alias("x")).select("path", "x.solvable", F.col("x.confidences").alias("confidence"))
    return got.select("path", F.size("docs").cast("long").alias("n")).join(funnel.decide(each), "path").select("path", "n", "decision", "confidence")


_STEP = r"least(len(regexp_extract_all(answer, '(?i)step\s*\d|\bstep\b')), 3)"
_REFS = r"least(len(list_distinct(regexp_extract_all(answer, '(?i)document\s+[a-z0-9]+'))), 2)"
QUALITY = f"""qs as (select conv_id, turn, greatest(0, least(1, 0.85 * (0.30 * case when conv_id % 3 = 0 then 0.7 else 0.85 end + 0.20 * case when {_WANT} = '' or {_WANT} in ({LIST(tx.PRONOUN_ANSWERS)[1:-1]}) then 0.3 when {N.format('short')} > 4 then 0.7 else 0.95 end + 0.20 * least(1.0, 0.4 + 0.2 * ({_STEP} + {_REFS})) + 0.15 * (0.4 + 0.3 * (case when {STRIP.format('question')} like '%?' then 1 else 0 end + case when len(list_filter({LIST(tx.QUESTION_OPENINGS)}, lambda o: starts_with({_LOW}, o))) > 0 then 1 else 0 end)) + 0.15 * least(1.0, 0.3 + 0.2 * len(list_distinct(['t' || (conv_id % 3), 't' || (turn % 2)])) + 0.1 * len(list_distinct([3, 2, turn % 4])))) + 0.15 * case when turn % 6 = 2 then 0.65 else 0.8 end)) as q from r)"""


def _quality(spark, d) -> DataFrame:
    r = _records(spark, d)
    titles = F.array(F.concat(F.lit("t"), (F.col("conv_id") % 3).cast("string")), F.concat(F.lit("t"), (F.col("turn") % 2).cast("string")))
    grades = F.array(F.lit(3), F.lit(2), (F.col("turn") % 4).cast("int"))
    solvability = F.when(F.col("conv_id") % 3 != 0, 0.85).otherwise(0.0)
    judge = F.when(F.col("turn") % 6 != 2, 0.8)
    return r.withColumn("quality", F.round(funnel.quality_score(F.col("short"), F.col("answer"), F.col("question"), titles, grades, solvability, judge), 6))


@query("quality_score", f"with {TURNS}, {QUALITY} select conv_id, turn, round(q, 6)::double as quality from qs")
def quality_score(spark, d):
    return _quality(spark, d).select("conv_id", "turn", "quality")


@query("report_samples", f"with {TURNS}, {QUALITY}, x as (select conv_id * 1000 + turn as id, round(q, 6)::double as quality from qs), b as (select id, quality, row_number() over (order by quality desc, id) as place, count(*) over () as n from x) select 'best' as kind, cast(place as int) as place, id, quality from b where place <= 5 union all select 'worst', cast(place - greatest(n - 3, 0) as int), id, quality from b where place > n - 3 and n >= 3")
def report_samples(spark, d):
    r = stash(_quality(spark, d).select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "quality"), "records")
    return evaluation.samples(r, "id", "quality")


_NORM = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda w: w not in ('', 'a', 'an', 'the'))"


@query("answer_norm_f1_em", f"""with {TURNS}, t as (select conv_id, turn, {_NORM.format('short')} as p, {_NORM.format("array_to_string(list_slice(regexp_split_to_array(trim(answer), '\\s+'), 2, 5), ' ')")} as g from r),
n as (select *, list_sum(list_transform(list_distinct(p), lambda w: least(len(list_filter(p, lambda x: x = w)), len(list_filter(g, lambda x: x = w))))) as k from t) select conv_id, turn, round(case when k > 0 then 2 * k / (len(p) + len(g)) else 0 end, 6)::double as f1, case when p = g then 1.0 else 0.0 end::double as em from n""")
def answer_norm_f1_em(spark, d):
    """The short answer against the second to fifth words of the long one."""
    gold = F.array_join(F.slice(F.split(F.btrim("answer"), r"\s+"), 2, 4), " ")
    f1, em = evaluation.answer_scores(F.col("short"), gold)
    return _records(spark, d).select("conv_id", "turn", F.round(f1, 6).alias("f1"), em.alias("em"))


def _bins(field: str, column: str) -> str:
    e = evaluation.EDGES[field]
    counts = ", ".join(f"count(*) filter ((n >= {e[i]} and n < {e[i + 1]}){f' or n >= {e[-1]}' if i == len(e) - 2 else ''})" for i in range(len(e) - 1))
    return f"select '{field}' as field, 'words' as value, array_to_string([{counts}], ',') as counts, round(avg(n), 2) as share from (select {N.format(column)} as n from r)"


@query("dataset_distributions", f"with {TURNS}, k as (select {KIND} as kind from (select {STRIP.format('short')} as s from r)) {_bins('query', 'question')} union all {_bins('short_answer', 'short')} union all {_bins('long_answer', 'answer')} union all select 'answer_type', kind, count(*)::varchar, round(count(*) / sum(count(*)) over (), 4) from k group by kind union all select 'hop_count', (1 + turn % 3)::varchar, count(*)::varchar, round(count(*) / sum(count(*)) over (), 4) from r group by 1 + turn % 3")
def dataset_distributions(spark, d):
    r = _records(spark, d).select(F.col("question").alias("query"), F.col("short").alias("short_answer"), F.col("answer").alias("long_answer"), tx.answer_type(F.col("short")).alias("answer_type"), (1 + F.col("turn") % 3).alias("hop_count"))
    words = evaluation.lengths(r).select("field", F.lit("words").alias("value"), F.array_join(F.transform("counts", lambda x: x.cast("string")), ",").alias("counts"), F.col("mean").alias("share"))
    return words.unionByName(evaluation.shares(r, ["answer_type", "hop_count"]).select("field", "value", F.col("n").cast("string").alias("counts"), "share"))


_GATES = ", ".join(f"({k!r}, {v})" for k, v in evaluation.GATES.items())


@query("quality_gates", f"""with rec as (select lang, quality, 1 + quality + toxic as hops from labels join documents using (doc_id)), a as (select count(*) as n, avg(quality) as q, count(*) filter (hops >= 2) / count(*) as h from rec), t as (select max(k) as k from (select count(*) as k from rec group by lang)),
g(gate, threshold) as (values {_GATES}), v as (select gate, threshold, case gate when 'multihop_rate' then h when 'avg_quality_score' then q when 'max_reasoning_type_share' then k / n when 'min_accepted_pct' then n / 300 when 'bm25_recall_at_10_max' then 0.65 else 0.61 end as value from g, a, t)
select gate, round(value, 6)::double as value, threshold::double as threshold, case when gate in {evaluation.CEILINGS} then value <= threshold else value >= threshold end as pass from v""")
def quality_gates(spark, d):
    """Labelled documents as records: the language as type, the label as quality, both labels as hops."""
    r = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "lang"), "doc_id")
    r = r.select(F.col("lang").alias("reasoning_type"), F.col("quality").cast("double").alias("quality_score"), (1 + F.col("quality") + F.col("toxic")).alias("hop_count"))
    return evaluation.gates(r, 300, 0.65, 0.61)


PICKS = """dq as (select item_id as query, y.vec_id as doc, round(list_dot_product(x.embedding::double[], y.embedding::double[]), 6) as score from benchmark join embeddings x on x.vec_id = item_id join embeddings y on y.vec_id <> x.vec_id where not exists (select 1 from gold where gold.query = item_id and gold.doc = y.vec_id)),
de as (select query, doc, row_number() over (partition by query order by score desc, doc) as k from dq), d2 as (select * from de where k <= 2), l7 as (select r.query, r.doc, r.rank from r where rank <= 7 and not exists (select 1 from gold where gold.query = r.query and gold.doc = r.doc) and not exists (select 1 from d2 where d2.query = r.query and d2.doc = r.doc)),
l1 as (select query, doc from (select *, row_number() over (partition by query order by rank) as k from l7) where k <= 1), mix as (select query, doc, 'embedding' as source, k as o from d2 union all select query, doc, 'bm25', 9 from l1)"""


def _mix(spark, d) -> DataFrame:
    """Distractors of the benchmark's items: the vector of an item's number against all, and BM25 over documents."""
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    q = v.join(table(spark, d, "benchmark").select(F.col("item_id").alias("id")), "id", "left_semi")
    gold = stash(_gold(spark, d), "gold")
    # as many as gold could take away, and two
    most = gold.groupBy("query").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    dense = similarity.vector_topk(q, v, int(most) + 2)
    return retrieval.distractors(dense, _bm25(spark, d), gold)


@query("distractor_mix", BM25 + f", {GOLD}, {PICKS} select query, doc, source, cast(row_number() over (partition by query order by o) as int) as place from mix")
def distractor_mix(spark, d):
    return _mix(spark, d).select("query", "doc", "source", "place")


@query("annotated_records", f"with {TURNS}, {QUALITY}, x as (select r.conv_id * 1000 + r.turn as path, question, short, round(q, 6) as quality, r.conv_id, r.turn from r join qs using (conv_id, turn)), k as (select *, {KIND} as answer_type from (select *, {STRIP.format('short')} as s from x)) select printf('q_%05d', row_number() over (order by quality desc, path) - 1) as query_id, path, case when turn % 3 = 0 then 'comparison' when turn % 3 = 1 then 'bridge_entity' else 'bridge_entity' end as reasoning_type, cast(2 + case when turn % 4 >= 2 then 1 else 0 end as int) as hop_count, answer_type, conv_id || ':3,' || (conv_id + 1) || ':2,' || (conv_id + 900000) || ':' || (turn % 4) || ',' || (conv_id + 2) || ':0' as documents, case when conv_id + 900000 in (select doc_id from documents) then 4 else 3 end as n_titled from k")
def annotated_records(spark, d):
    """Records with three supporting documents, the third unknown, and a distractor; a third of the types come from paths."""
    r = _quality(spark, d).withColumn("path", F.col("conv_id") * 1000 + F.col("turn"))
    doc = lambda i, g: F.struct((F.col("conv_id") + i).alias("doc"), g.cast("int").alias("grade"))
    rec = r.select("path", "question", "short", F.lit("bridge_entity").alias("reasoning_type"), "quality", F.array(doc(0, F.lit(3)), doc(1, F.lit(2)), doc(900000, F.col("turn") % 4)).alias("docs"))
    types = r.select("path", F.when(F.col("turn") % 3 == 0, "comparison").when(F.col("turn") % 3 == 1, "").alias("reasoning_type"))
    mixed = r.select(F.col("path").alias("query"), (F.col("conv_id") + 2).alias("doc"), F.lit("bm25").alias("source"), F.lit(1).alias("place"))
    titles = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), F.concat(F.lit("title "), F.col("doc_id").cast("string")).alias("title"))
    a = evaluation.annotate(rec, titles, types, mixed)
    shown = F.array_join(F.transform("documents", lambda x: F.concat(x["doc"].cast("string"), F.lit(":"), x["grade"].cast("string"))), ",")
    return a.select("query_id", "path", "reasoning_type", "hop_count", "answer_type", shown.alias("documents"), F.size(F.filter("documents", lambda x: x["title"] != "")).alias("n_titled"))


@query("docs_block", """with t as (select conv_id as doc, turn as idx, coalesce(text, '') as text, turn % 5 = 3 as hinted from conversations), p as (select distinct conv_id as path, unnest([0, 1]) as pos from conversations), q as (select path, pos, path + pos as doc from p),
c as (select path, pos, q.doc, idx, text, row_number() over (partition by path, pos order by case when hinted then 0 else 1 end, idx) as k from q join t using (doc)), b as (select q.path, q.pos, '--- Document ' || substr('AB', q.pos + 1, 1) || ' (doc_id: ' || q.doc || ', title: "' || case when exists (select 1 from documents d where d.doc_id = q.doc) then 'title ' || q.doc else '' end || '") ---' || chr(10) || coalesce((select string_agg(substr(text, 1, 200), chr(10) order by k) || chr(10) from c where c.path = q.path and c.pos = q.pos and k <= 3), '') as t from q)
select path, string_agg(t, chr(10) order by pos) as block from b group by 1""")
def docs_block(spark, d):
    """Two conversations as the documents of a path, their turns as chunks; every fifth turn is hinted."""
    c = table(spark, d, "conversations")
    chunks = c.select(F.col("conv_id").alias("doc"), F.col("turn").alias("idx"), F.col("text").alias("chunk_text"))
    docs = c.select(F.col("conv_id").alias("path")).distinct().select("path", F.explode(F.array(F.lit(0), F.lit(1))).alias("pos")).withColumn("doc", F.col("path") + F.col("pos"))
    hinted = docs.join(chunks.filter("idx % 5 = 3"), "doc").select("path", "doc", "idx")
    titles = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), F.concat(F.lit("title "), F.col("doc_id").cast("string")).alias("title"))
    return passages.documents_block(docs, chunks, hinted, titles, 3, 200)


_FIELD = "'query: ' || coalesce(text, '') || chr(10) || 'short_answer: ' || coalesce(role, '') || chr(10) || 'long_answer: ' || chr(10) || 'bridge_entity: ' || chr(10) || 'reasoning_type: ' || chr(10) || 'reasoning_chain: ' || chr(10)"


@query("candidates_block", f"with x as (select conv_id as path, row_number() over (partition by conv_id order by turn) - 1 as pos, {_FIELD} as t from conversations) select path, string_agg('--- CANDIDATE ' || pos || ' ---' || chr(10) || t, chr(10) order by pos) as block from x group by 1")
def candidates_block(spark, d):
    c = table(spark, d, "conversations")
    return passages.candidates_block(c.select(F.col("conv_id").alias("path"), F.col("turn").alias("idx"), F.col("text").alias("query"), F.col("role").alias("short_answer")))


@query("ref_sample_projection", "select conv_id, turn, coalesce(text, '') as query, coalesce(nullif(case when turn % 2 = 0 then '' else role end, ''), 'short ' || turn) as short_answer, case when turn % 3 = 0 then 2 else turn end as hop_count from conversations order by conv_id, turn limit 100")
def ref_sample_projection(spark, d):
    """Rows whose answer is empty now and then, with a second name for it."""
    c = table(spark, d, "conversations").select("conv_id", "turn", F.col("text").alias("question"), F.when(F.col("turn") % 2 != 0, F.col("role")).otherwise("").alias("answer"), F.concat(F.lit("short "), F.col("turn").cast("string")).alias("short_answer"), F.when(F.col("turn") % 3 != 0, F.col("turn")).alias("hop_count"))
    return reference_sample(c, 100, ["conv_id", "turn"])
