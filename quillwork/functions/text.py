"""Scalar text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Stop words.
STOP = tuple(
    "a an the and or but if then when while of at by for from in on to with as "
    "is are was were be been being do does did have has had can could should would "
    "may might must will shall this that these those who whom whose which what where "
    "when why how not no yes it its his her their them they he she him them our your "
    "we us you i me my mine yours ours theirs both each every such any some more most "
    "other another few many much less".split()
)
#: Openings of standard questions.
QUESTION_OPENINGS = ("who", "what", "where", "when", "which", "how", "why", "in what", "by what", "during what", "into what", "of what", "from what", "on what")
#: Answers that are pronouns or bare verdicts.
PRONOUN_ANSWERS = ("it", "they", "he", "she", "him", "her", "them", "us", "you", "we", "yes", "no", "maybe", "true", "false")
#: Prefixes of link targets outside the articles.
NAMESPACES = ("file:", "image:", "category:", "help:", "portal:", "template:", "user:", "talk:", "wikipedia:", "book:", "special:")
#: Fixed value: months of dates.
MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december"


def literals(values) -> Column:
    return F.array(*[F.lit(v) for v in dict.fromkeys(values)])


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    """White space off both ends, any that Unicode knows."""
    return F.regexp_replace(text(c), r"(?U)^\s+|\s+$", "")


def tokens(c: Column) -> Column:
    """Alphanumeric tokens of the lower-cased text, in order, with repeats."""
    return F.regexp_extract_all(F.lower(text(c)), F.lit("[a-z0-9]+"), F.lit(0))


def content_tokens(c: Column) -> Column:
    return F.filter(tokens(c), lambda w: ~F.array_contains(literals(STOP), w))


def content_set(c: Column) -> Column:
    return F.array_except(tokens(c), literals(STOP))


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(text(c), r"(?U)\s+"), lambda w: w != "")).cast("long")


def years(c: Column) -> Column:
    """Years 1000-2099 that stand alone, in order, with repeats."""
    return F.regexp_extract_all(text(c), F.lit(r"(?U)\b(1[0-9]{3}|20[0-9]{2})\b"), F.lit(1))


def sentences(c: Column) -> Column:
    """Cut after . ! or ? before white space; trimmed, no empty ones."""
    return F.filter(F.transform(F.split(text(c), r"(?<=[.!?])\s+"), strip), lambda s: s != "")


def decoded(href: Column) -> Column:
    """Decoded, trimmed and lower-cased. Escapes are decoded one by one: a bad one, and a plus sign, stay as they are."""
    raw = F.regexp_replace(F.replace(text(href), F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.lower(strip(F.coalesce(F.try_url_decode(raw), raw)))


def link_target(href: Column) -> Column:
    """The target of a link as decoded; null if empty, in a namespace, or with a fragment."""
    t = decoded(href)
    bad = (t == "") | F.contains(t, F.lit("#")) | t.rlike("^(wikt:|" + "|".join(NAMESPACES) + ")")
    return F.when(~bad, t)


def link_targets(hrefs: Column) -> Column:
    """Distinct targets in the order of their first links."""
    return F.array_distinct(F.filter(F.transform(hrefs, link_target), lambda t: t.isNotNull()))


def jaccard(a: Column, b: Column) -> Column:
    x, y = content_set(a), content_set(b)
    return F.when((F.size(x) > 0) & (F.size(y) > 0), F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))).otherwise(0.0)


def overlap_fraction(question: Column, chunk: Column) -> Column:
    """Share of the question's content tokens, with repeats, that the chunk has."""
    q, c = content_tokens(question), content_set(chunk)
    return F.when(F.size(q) > 0, F.size(F.filter(q, lambda w: F.array_contains(c, w))) / F.size(q)).otherwise(0.0)


def normal_answer(c: Column) -> Column:
    """Lower case, articles out, then punctuation to spaces, then single spaces."""
    t = F.regexp_replace(F.lower(strip(c)), r"(?U)\b(a|an|the)\b", " ")
    return strip(F.regexp_replace(F.regexp_replace(t, r"[!-/:-@\[-`{-~]", " "), r"(?U)\s+", " "))


def bounded(low: Column, want: Column) -> Column:
    """Whether want occurs in low with a border of words at both of its ends; not if it is empty."""
    n = F.length(want)
    word = lambda x: F.coalesce(x.rlike(r"(?U)^\w$"), F.lit(False))
    places = F.filter(F.sequence(F.lit(1), F.greatest(F.length(low), F.lit(1))), lambda i: F.substring(low, i, n) == want)
    start = lambda i: word(F.when(i > 1, F.substring(low, i - 1, F.lit(1)))) != word(F.substring(want, F.lit(1), F.lit(1)))
    end = lambda i: word(F.substring(low, i + n, F.lit(1))) != word(F.substring(want, n, F.lit(1)))
    return (want != "") & F.contains(low, want) & F.exists(places, lambda i: start(i) & end(i))


def answer_type(c: Column) -> Column:
    """Kind of a short answer. The patterns, and three words at most for a name."""
    s = strip(c)
    parts = F.split(s, r"\s+")
    capital = lambda w: (F.substring(w, 1, 1) == F.upper(F.substring(w, 1, 1))) & (F.substring(w, 1, 1) != F.lower(F.substring(w, 1, 1)))
    return (
        F.when(s == "", "empty")
        .when(s.rlike(r"^-?\d+(\.\d+)?$"), "numeric")
        .when(s.rlike(rf"(?i)^({MONTHS})\s+\d+"), "date")
        .when(s.rlike(r"^\d{1,4}[/-]\d{1,4}([/-]\d{2,4})?$"), "date")
        .when(F.lower(s).isin("yes", "no", "true", "false"), "boolean")
        .when((F.size(parts) <= 3) & F.forall(parts, capital), "entity")
        .otherwise("phrase")
    )


def path_id(doc_ids: Column, bridge: Column) -> Column:
    """Key of a path by its documents, in any order, and its bridge."""
    return F.concat(F.lit("p_"), F.substring(F.sha1(F.concat(F.array_join(F.array_sort(doc_ids), "|"), F.lit("||"), bridge)), 1, 12))


def lenient_json(c: Column, schema: str) -> Column:
    """Parse a model's answer: fences go; else from the first { to the last }; null for anything else."""
    bare = strip(F.regexp_replace(text(c), r"```[a-zA-Z]*", ""))
    inner = F.regexp_extract(bare, r"(?s)\{.*\}", 0)
    good = lambda t: F.when(F.try_parse_json(t).isNotNull(), F.from_json(t, schema))
    return F.coalesce(good(bare), good(inner))
