"""Text functions on columns, all built-ins, so that they stay in generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from storyloom.functions import fixed

STORY_ID = r"[A-Z][A-Z0-9]+-\d+"


def _in(value: Column, words: list[str]) -> Column:
    return value.isin(*words)


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is worked out once however often the body names it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words of two or more ASCII letters, as they are written."""
    return F.regexp_extract_all(text, F.lit("[a-zA-Z]{2,}"), F.lit(0))


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(words(text)), F.lit(0))


def terms(text: Column, stop: list[str] = fixed.STOP_WORDS["retrieval"], least: int = 3) -> Column:
    """Index terms: lower-cased words of ``least`` letters or more that aren't stop words."""
    return F.filter(words(F.lower(text)), lambda w: (F.length(w) >= least) & ~_in(w, stop))


def frequencies(tokens: Column) -> Column:
    """Distinct tokens with how often each occurs: (term, tf), found in the row itself, without a shuffle."""

    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return let(starts, lambda b: F.transform(b, lambda i, k: F.struct(F.get(s, i).alias("term"), (F.coalesce(F.get(b, k + 1), F.size(s)) - i).cast("bigint").alias("tf"))))

    return F.when(F.size(tokens) > 0, let(F.sort_array(tokens), runs)).otherwise(F.array().cast("array<struct<term:string,tf:bigint>>"))


def estimated_tokens(n_words: Column) -> Column:
    return (n_words * F.lit(1.3)).cast("bigint")


def clean_markup(text: Column, compat: bool = False) -> Column:
    """Wiki mark-up cleaned away: struck text, colours, more than one blank line.

    By default struck text goes (also ``<s>``, ``<strike>``, ``<del>`` and styled
    line-through), and dashes inside words stay; ``compat`` keeps the text between two dashes.
    """
    out = F.trim(text)
    if compat:
        out = F.regexp_replace(out, r"(?<!^)(?<!\n)-([^-\n]+)-", "$1")
    else:
        out = F.regexp_replace(out, r"(?is)<(s|strike|del)\b[^>]*>.*?</\1>", "")
        out = F.regexp_replace(out, r"(?is)<(\w+)[^>]*line-through[^>]*>.*?</\1>", "")
        out = F.regexp_replace(out, r"(^|[ \n(])-(?=[^ \n-])([^\n]*?[^ \n-])-(?=[ \n.,;:)]|$)", "$1")
    out = F.regexp_replace(out, r"\{color(:[^}]+)?\}", "")
    return F.regexp_replace(out, r"\n{3,}", "\n\n")


def wiki_to_markdown(text: Column, compat: bool = False) -> Column:
    """Headings, bold, code and lists of wiki mark-up in markdown; ``compat`` turns first-level headings into lists, too."""
    lists = lambda t: F.regexp_replace(F.regexp_replace(t, r"(?d)(?m)^\*\s", "- "), r"(?d)(?m)^#\s", "1. ")

    def headings(t: Column) -> Column:
        for n in range(1, 7):
            t = F.regexp_replace(t, rf"(?d)(?m)^h{n}\.\s*", "#" * n + " ")
        return t

    inline = lambda t: F.regexp_replace(F.regexp_replace(t, r"\*([^*\n]+)\*", "**$1**"), r"\{\{([^}]+)\}\}", "`$1`")
    return lists(inline(headings(text))) if compat else headings(inline(lists(text)))


def truncated(text: Column, n: int) -> Column:
    """On one line, bars escaped, and with an ellipsis if longer than ``n``."""
    line = F.replace(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit("|"), F.lit("\\|"))
    return F.when(F.length(line) > n, F.concat(F.left(line, F.lit(n - 1)), F.lit("…"))).otherwise(line)


def split_camel(name: Column) -> Column:
    """Words of a CamelCase or underscored name."""
    spaced = F.regexp_replace(F.replace(name, F.lit("_"), F.lit(" ")), r"(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", " ")
    return F.filter(F.split(spaced, r"\s+"), lambda w: w != "")


def initials(parts: Column) -> Column:
    """First letters of two or more words; null of fewer."""
    return F.when(F.size(parts) >= 2, F.array_join(F.transform(parts, lambda w: F.upper(F.left(w, F.lit(1)))), ""))


def name_parts(api_name: Column) -> Column:
    return F.split(api_name, "__")


def object_category(api_name: Column, compat: bool = False) -> Column:
    """Kind of an object by its suffix; ``compat`` looks for the suffix anywhere."""
    has = (lambda s: F.contains(api_name, F.lit(s))) if compat else (lambda s: F.endswith(api_name, F.lit(s)))
    managed = F.when(F.size(name_parts(api_name)) >= 3, "managed_package").otherwise("custom_object")
    return F.when(has("__e"), "platform_event").when(has("__mdt"), "custom_metadata").when(has("__x"), "external_object").when(has("__c"), managed).otherwise("standard_object")


def namespace(api_name: Column) -> Column:
    return F.when(F.size(name_parts(api_name)) >= 3, F.element_at(name_parts(api_name), 1))


def base_name(api_name: Column) -> Column:
    """Without namespace and suffix."""
    parts = name_parts(api_name)
    return F.when(F.size(parts) >= 3, F.element_at(parts, 2)).otherwise(F.element_at(parts, 1))


def search_variants(api_name: Column, label: Column) -> Column:
    """Lower-cased ways in which an object may be written, distinct and sorted."""
    base = base_name(api_name)
    parts = split_camel(base)
    under = F.contains(base, F.lit("_"))
    ways = F.array(base, label, F.when(under, F.replace(base, F.lit("_"), F.lit(" "))), F.when(under, F.replace(base, F.lit("_"), F.lit(""))), F.when((F.size(parts) == 1) & (F.length(F.get(parts, F.lit(0))) >= 5), F.get(parts, F.lit(0))))
    return F.array_sort(F.array_distinct(F.filter(F.transform(ways, lambda v: F.lower(v)), lambda v: v.isNotNull() & (v != ""))))


def split_values(text: Column, separators: str = "[,;]+") -> Column:
    """Trimmed, non-empty values of a field with many."""
    return F.filter(F.transform(F.split(text, separators), lambda v: F.trim(v)), lambda v: v != "")


COMPONENT_SEPARATORS = r"[,;\n/|]"


def epic_of(*fields: Column) -> Column:
    """"Epic: ..." or "Feature: ..." in the first field that has either, 80 characters at most."""
    patterns = [r"(?id)Epic[:\-]\s*(.+?)(?:[|.;]|$)", r"(?id)Feature[:\-]\s*(.+?)(?:[|.;]|$)"]
    found = [F.nullif(F.trim(F.regexp_extract(F.trim(f), p, 1)), F.lit("")) for f in fields for p in patterns]
    return F.left(F.coalesce(*found, F.lit("_Unassigned_")), F.lit(80))


def intents(text: Column) -> Column:
    """Intents of a question, in their order; ``general`` if there are none."""
    found = F.array_compact(F.array(*(F.when(reduce(lambda a, b: a | b, (F.rlike(text, F.lit("(?i)" + p)) for p in ps)), F.lit(name)) for name, ps in fixed.INTENTS.items())))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("general")))


def label_bucket(label: Column) -> Column:
    low = F.lower(label)
    return F.when(F.rlike(low, F.lit("|".join(fixed.ENVIRONMENT_WORDS))), "environment").when(F.rlike(low, F.lit("|".join(fixed.PROCESS_WORDS))), "process").otherwise("other")


def components_mentioned(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(fixed.COMPONENT_PATTERN), F.lit(0)))


def paths_mentioned(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(fixed.PATH_PATTERN), F.lit(0)))


def normal_path(path: Column) -> Column:
    """From the first of the known top folders on."""
    found = F.regexp_extract(path, r"((?:knowledge|artifacts|scripts)/.*)$", 1)
    return F.when(found != "", found).otherwise(path)


def is_defect(kind: Column, criteria: Column) -> Column:
    return F.lower(F.coalesce(kind, F.lit(""))).isin("bug", "defect") | F.lower(F.trim(F.coalesce(criteria, F.lit("")))).isin(*fixed.EMPTY_CRITERIA)


def size_bucket(size: Column) -> Column:
    return F.when(size < 500, "<500B").when(size < 2000, "500B-2KB").when(size < 10000, "2KB-10KB").otherwise(">=10KB")


def quality_score(*, description: Column, criteria: Column, solution: Column, linked: Column, components: Column, assignee: Column) -> Column:
    """0 to 100 points; the first four are word counts of sections, the others fields.

    15 description, 25 criteria, 25 solution (each from four words on), 10 more each
    for criteria and solution of 100 words, 5 linked issues, 5 each for the fields.
    """
    point = lambda c, n: F.when(F.coalesce(c, F.lit(False)), n).otherwise(0)
    given = lambda f: F.trim(f) != ""
    return (
        point(description > 3, 15) + point(criteria > 3, 25) + point(solution > 3, 25) + point(criteria >= 100, 10) + point(solution >= 100, 10)
        + point(linked > 0, 5) + point(given(components), 5) + point(given(assignee), 5)
    )


def quality_band(score: Column) -> Column:
    return F.when(score <= 20, "0-20").when(score <= 40, "21-40").when(score <= 60, "41-60").when(score <= 80, "61-80").otherwise("81-100")


def similarity_band(sim: Column) -> Column:
    return F.when(sim >= 0.5, "excellent").when(sim >= 0.3, "good").when(sim >= 0.1, "partial").otherwise("poor")


def cache_rate(cached: Column, fresh: Column) -> Column:
    both = cached + fresh
    return F.when(both > 0, F.round(cached / both * 100, 1)).otherwise(0.0)


def personas(text: Column) -> Column:
    """Roles of "As a ...": lower-cased, 3 to 50 characters, no descriptions of people."""
    found = F.regexp_extract_all(text, F.lit(fixed.PERSONA_PATTERN), F.lit(1))
    return F.array_distinct(F.filter(F.transform(found, lambda r: F.lower(F.trim(r))), lambda r: F.length(r).between(3, 50) & ~F.rlike(r, F.lit(fixed.NOT_PERSONAS))))


def acronyms(text: Column, whole: bool = False) -> Column:
    """Runs of two to five capitals that aren't plain words; ``whole`` asks for word boundaries."""
    b = r"\b" if whole else ""
    return F.filter(F.array_distinct(F.regexp_extract_all(text, F.lit(f"{b}[A-Z]{{2,5}}{b}"), F.lit(0))), lambda a: ~_in(a, fixed.NOT_ACRONYMS))


def expansions(text: Column) -> Column:
    """(acronym, expansion) pairs in either order of "ABC (Words)" and "Words (ABC)", as they come."""
    name = fixed.EXPANDED_NAME
    both = F.regexp_extract_all(text, F.lit(rf"[A-Z]{{2,5}}\s*\({name}\)|{name}\s*\([A-Z]{{2,5}}\)"), F.lit(0))
    pair = lambda m: F.struct(F.regexp_extract(m, r"\b([A-Z]{2,5})\b", 1).alias("acronym"), F.regexp_extract(m, rf"({name})", 1).alias("expansion"))
    return F.filter(F.transform(both, pair), lambda p: F.length(p["expansion"]) > 3)


def title_gerunds(title: Column) -> Column:
    """Lower-cased words in -ing of a title, of five letters or more."""
    bare = F.transform(F.split(F.coalesce(title, F.lit("")), r"\s+"), lambda w: F.lower(F.regexp_replace(w, fixed.WORD_MARKS, "")))
    return F.array_distinct(F.filter(bare, lambda w: F.endswith(w, F.lit("ing")) & (F.length(w) >= 5) & ~_in(w, fixed.NOT_PROCESSES)))


def pairs(tokens: Column, keep=None) -> Column:
    """Neighbours, joined by a space, both of which pass ``keep``."""

    def of(t: Column) -> Column:
        both = F.zip_with(t, F.slice(t, F.lit(2), F.greatest(F.size(t) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        kept = F.filter(both, lambda p: p["b"].isNotNull() if keep is None else p["b"].isNotNull() & keep(p["a"]) & keep(p["b"]))
        return F.transform(kept, lambda p: F.concat_ws(" ", p["a"], p["b"]))

    return let(tokens, of)


def document_bigrams(text: Column, stop: list[str] = fixed.STOP_WORDS["export"]) -> Column:
    """Distinct neighbours of which neither is a stop word nor shorter than three letters."""
    return F.array_distinct(pairs(words(F.lower(text)), lambda w: (F.length(w) > 2) & ~_in(w, stop)))


def story_ids(text: Column, pattern: str = STORY_ID) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern.lstrip("^").rstrip("$")), F.lit(0)))


def lenient_int(text: Column) -> Column:
    """Thousands commas allowed; anything else that isn't a whole number is 0."""
    return F.coalesce(_try_cast(text, "bigint"), F.lit(0).cast("bigint"))


def lenient_float(text: Column) -> Column:
    return F.coalesce(_try_cast(text, "double"), F.lit(0.0))


def _try_cast(text: Column, kind: str) -> Column:
    return F.replace(F.trim(text), F.lit(","), F.lit("")).try_cast(kind)


def lenient_timestamp(text: Column) -> Column:
    """Three accepted forms; null otherwise."""
    return F.coalesce(*(F.try_to_timestamp(F.trim(text), F.lit(f)) for f in ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm:ss"))).cast("timestamp_ntz")


def searchable_text(*parts: Column) -> Column:
    """Non-blank parts, joined by spaces."""
    return F.concat_ws(" ", *(F.nullif(F.trim(F.coalesce(p, F.lit(""))), F.lit("")) for p in parts))


def render(template: Column, **values: Column) -> Column:
    """``{{NAME}}`` replaced by its value."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{{" + name.upper() + "}}"), F.coalesce(value, F.lit("")))
    return template
