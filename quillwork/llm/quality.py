"""Line-first quality rules, in native column expressions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, carried, let, stash, words

#: Phrases of boilerplate lines, lower case, at least two words each.
BOILERPLATE = ("lorem ipsum", "enable javascript", "cookie policy", "uses cookies", "privacy policy", "terms of use", "terms of service", "rights reserved", "sign in to", "log in to", "subscribe to our", "click here", "share this", "powered by")
#: Separators of menus and breadcrumb lines.
SEPARATORS = r"[|»›•·]"
#: Characters that end a sentence or a quotation.
SENTENCE_ENDS = (".", "!", "?", "…", ":", ";", "。", "！", "？", '"', "”", "»", "'", ")", "]")


@dataclass(frozen=True)
class Rules:
    """Thresholds of the line rules and of the document rule."""

    min_words: int = 50
    max_repeat_percent: int = 50
    navigation_separators: int = 3  # a line with so many separators is a menu
    short_line_words: int = 3  # a line with fewer words must end as a sentence does
    max_boilerplate_words: int = 40  # longer lines only mention the phrase
    max_lost_percent: int = 50  # documents that lose more of their words go


def has_phrase(line: Column) -> Column:
    def of(low: Column) -> Column:
        out = F.lit(False)
        for p in BOILERPLATE:
            out = out | F.contains(low, F.lit(p))
        return out

    return let(F.lower(line), of)


def line_fails(line: Column, rules: Rules, phrases: Column) -> Column:
    """True for a line that breaks a punctuation, navigation or boilerplate rule. Lines without a word never fail.

    phrases: whether the document has a boilerplate phrase at all (has_phrase of its text); the line is searched only then.
    """
    white, word = r"[ \t\n\x0B\f\r]", r"[^ \t\n\x0B\f\r]"
    few = line.rlike(rf"^{white}*{word}+({white}+{word}+){{0,{rules.short_line_words - 2}}}{white}*$")
    ends = F.right(F.btrim(line, F.lit(WHITE)), F.lit(1)).isin(*SENTENCE_ENDS)
    menu = line.rlike(rf"({SEPARATORS}[^|»›•·]*){{{rules.navigation_separators}}}")
    phrase = F.when(phrases, has_phrase(line) & (F.size(words(line)) <= rules.max_boilerplate_words)).otherwise(False)
    return (few & ~ends) | menu | phrase


#: A sorted array element holds 44 bits of a window's hash and 20 bits of its place.
PLACE = 20


def add_repeat_words(df: DataFrame, ws: str, out: str) -> DataFrame:
    """Add the number of words of array ws that lie in a 3-word window found twice or more.

    One sort of longs in each row; equal hashes are confirmed on the words, and a row with a false match, or with
    2^20 words or more, goes by a sort of the windows themselves. Exact.
    """
    n, mask = F.size(ws), (1 << PLACE) - 1
    w = F.col(ws)
    window = lambda i: (F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    key = F.when(n < 4, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(*window(i)).bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long"))))
    near = lambda x, y: F.coalesce(F.shiftrightunsigned(x.bitwiseXOR(y), PLACE) == 0, F.lit(False))
    place = lambda x: x.bitwiseAND(F.lit(mask)).cast("int")
    df = df.withColumn("_rk", F.sort_array(key))
    s = F.col("_rk")
    df = df.withColumn("_rd", F.filter(s, lambda x, i: near(x, F.get(s, i + 1)) | near(x, F.get(s, i - 1))))
    d = F.col("_rd")
    differs = lambda x, y: near(x, y) & ~F.reduce(F.array(*[F.get(w, place(x) + k) == F.get(w, place(y) + k) for k in range(3)]), F.lit(True), lambda t, v: t & v)
    df = df.withColumn("_rf", (n > mask) | F.exists(F.sequence(F.lit(0), F.size(d)), lambda i: F.coalesce(differs(F.get(d, i), F.get(d, i + 1)), F.lit(False))))
    plain = F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))), lambda i: F.struct(*[x.alias(c) for x, c in zip(window(i), "abc", strict=True)], i.alias("i")))
    full = lambda t: F.transform(F.filter(t, lambda x, i: same(x, F.get(t, i + 1)) | same(x, F.get(t, i - 1))), lambda x: x["i"])
    same = lambda x, y: F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))
    df = df.withColumn("_ri", F.when(F.col("_rf"), F.sort_array(let(F.sort_array(plain), full))).otherwise(F.sort_array(F.transform(d, place))))
    p = F.col("_ri")
    count = F.aggregate(F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(3)), F.lit(3))), F.lit(0), lambda t, x: t + x)
    return df.withColumn(out, count.cast("long")).drop("_rk", "_rd", "_rf", "_ri")


ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_words", "clean_text", "base_failed", "kept")


def judged(docs: DataFrame, rules: Rules) -> DataFrame:
    """(_row, text, what measures adds): _row holds the input's columns."""
    t = F.coalesce(F.col("text"), F.lit(""))
    has_word = lambda x: F.btrim(x, F.lit(WHITE)) != ""
    d = carried(docs, "text").withColumn("_w", words(t)).withColumn("_l", F.split(t, "\n"))
    d = d.withColumn("_real", F.filter("_l", has_word))
    # let: the optimiser would otherwise move the first argument into the lambda, and so to every line
    lines = lambda keep: let(has_phrase(t), lambda p: F.filter("_l", lambda x: keep(line_fails(x, rules, p))))
    d = d.withColumn("_bad", lines(lambda fails: fails))
    d = d.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.translate(t, WHITE, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long"),
        "n_dup_lines": (F.size("_real") - F.size(F.array_distinct("_real"))).cast("long"),
        "lost_words": F.aggregate("_bad", F.lit(0), lambda s, x: s + F.size(words(x))).cast("long"),
        "clean_text": F.when(F.size("_bad") == 0, t).otherwise(F.array_join(lines(lambda fails: ~fails), "\n")),
    })
    d = add_repeat_words(d, "_w", "n_repeat_words")
    d = d.withColumn("base_failed", (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")))
    return d.withColumn("kept", ~F.col("base_failed") & (100 * F.col("lost_words") <= rules.max_lost_percent * F.col("n_words")))


def measures(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Add the document measures, the cleaned text and the verdicts; every input row and column stays.

    Added: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost_words (long), clean_text, base_failed,
    kept. A null or empty text has no words: all counts are 0, base_failed is true and kept false. Input columns
    with the name of an added one are replaced; any others stay. Repeated rows are judged one by one. An empty table
    gives an empty result.
    """
    own = [F.col("_row").getField(c).alias(c) for c in docs.columns if c not in ADDED]
    return judged(docs, rules).select(*own, *ADDED)


def query(spark, sf_dir: str) -> DataFrame:
    d = measures(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_words", "base_failed", "kept")


_PHRASES = " or ".join(f"contains(lower(line), '{p}')" for p in BOILERPLATE)
_ENDS = ", ".join("'" + x.replace("'", "''") + "'" for x in SENTENCE_ENDS)

#: DuckDB: the rules line by line and the windows of three words one by one, for the query.
SQL = rf"""
with d as (select doc_id, coalesce(text, '') as t, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') as w from documents),
l as (select doc_id, line, list_filter(regexp_split_to_array(line, '[ \t\x0B\f\r]+'), lambda x: x <> '') as lw from (select doc_id, unnest(string_split(t, chr(10))) as line from d)),
dup as (select doc_id, count(*) - count(distinct line) as n from l where len(lw) > 0 group by 1),
bad as (select doc_id, sum(len(lw)) as n from l where (len(lw) between 1 and 2 and not list_contains([{_ENDS}], right(lw[-1], 1))) or len(regexp_extract_all(line, '[|»›•·]')) >= 3 or (({_PHRASES}) and len(lw) <= 40) group by 1),
win as (select doc_id, unnest(range(1, len(w) - 1)) as i, w from d where len(w) >= 3), rep as (select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as k from win),
cov as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from rep where k > 1) group by 1),
m as (select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars, cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols, cast(coalesce(dup.n, 0) as bigint) as n_dup_lines, cast(coalesce(cov.n, 0) as bigint) as n_repeat_words, cast(coalesce(bad.n, 0) as bigint) as lost_words from d left join dup using (doc_id) left join cov using (doc_id) left join bad using (doc_id))
select *, (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed, not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and 100 * lost_words <= 50 * n_words as kept from m
"""


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the rules keep, with their text and all columns, of any name, as they were.

    Null and empty texts go. Repeated rows are judged one by one. An empty table gives an empty result. The verdicts are
    written before the filter: pushed below the measures, it would have each of them computed anew for every element of
    the arrays.
    """
    return stash(judged(docs, Rules()).select("_row", "kept"), "judged").filter("kept").select("_row.*")
