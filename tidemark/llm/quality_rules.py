"""Quality rules: a table of thresholds, compiled into one Spark projection.

A rule compares a measure of the text, or its share of another measure, with a limit. :data:`MEASURES` says how each measure
is computed from the text, its words and its lines with built-in functions, :data:`RULES` is the table, and :func:`judge`
turns both into one expression: words and lines are split once and bound, the measures are bound once, and every rule reads
those. Nothing is shuffled and no user function runs. Shares are compared as whole numbers (100 * part against percent *
whole), so no rounding decides.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters that end a word.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
BLANK_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
LETTER_WORD = r"[^\x20\x09-\x0D\p{L}]*\p{L}[^\x20\x09-\x0D]*"
BULLETS = ("-", "*", "•", "‣", "·")
ELLIPSES = ("...", "…")
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "that", "is", "for", "with", "as",
    "der", "die", "das", "und", "zu", "den", "ein", "nicht", "von", "mit",
    "le", "la", "les", "de", "et", "un", "une", "que", "en", "est",
    "el", "los", "y", "del", "se", "por", "con", "no", "su", "para",
)


class Rule(NamedTuple):
    """``measure`` (as percent of ``per``, if that is given) may not be below ``least`` nor above ``most``."""

    name: str
    measure: str
    per: str | None = None
    least: int | None = None
    most: int | None = None


#: The rules that every method shares; :data:`RULES` come on top.
BASE_RULES = (
    Rule("few_words", "n_words", least=50),
    Rule("repeated_words", "n_repeat_words", "n_words", most=50),
)
RULES = (
    Rule("many_words", "n_words", most=1_000_000),
    Rule("word_length", "word_chars", "n_words", least=200, most=1500),
    Rule("symbols", "n_symbols", "n_words", most=10),
    Rule("wordless", "n_letter_words", "n_words", least=70),
    Rule("shouting", "n_bangs", "n_words", most=20),
    Rule("stop_words", "n_stop_words", least=2),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=40),
    Rule("bullets", "n_bullet_lines", "n_lines", most=90),
    Rule("ellipses", "n_ellipsis_lines", "n_lines", most=30),
)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def occurrences(text: Column, pattern: str) -> Column:
    """Matches of a pattern for one character."""
    return F.size(F.split(text, pattern)) - 1


def how_many(items: Column, test: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(items, test))


def covered_words(starts: Column, width: int) -> Column:
    """Words under windows of ``width`` words that begin at the ascending positions ``starts``."""
    until_next = F.transform(starts, lambda at, i: F.least(F.lit(width), F.coalesce(F.get(starts, i + 1) - at, F.lit(width))))
    return F.aggregate(until_next, F.lit(0), lambda total, n: total + n)


#: Up to so many distinct repeated windows are looked up one by one; beyond, all windows are sorted. Both give the same count.
FEW_REPEATED = 64


def repeated_words(words: Column, width: int = 3) -> Column:
    """Words in windows of ``width`` words that stand twice or more in the text, the first included.

    Where no two windows have one hash there is no repetition. Else the windows with a repeated hash (or all, where many
    repeat) are compared as text: sorted, equal ones stand side by side.
    """
    def windows(of: Callable[[list[Column], Column], Column]) -> Column:
        heads = F.slice(words, F.lit(1), F.greatest(F.size(words) - (width - 1), F.lit(0)))
        return F.transform(heads, lambda word, i: of([word, *(F.get(words, i + k) for k in range(1, width))], i))

    def placed(at: Column) -> Column:
        return F.struct(F.concat_ws(" ", *(F.get(words, at + k) for k in range(width))).alias("words"), at.alias("at"))

    def starts(ordered: Column) -> Column:
        same = lambda one, j: F.coalesce(F.get(ordered, j)["words"] == one["words"], F.lit(False))
        found = F.filter(ordered, lambda one, i: same(one, i - 1) | same(one, i + 1))
        return F.sort_array(F.transform(found, lambda one: one["at"]))

    def by_text(hashes: Column, repeated: Column) -> Column:
        every = F.sequence(F.lit(0), F.size(hashes) - 1)
        looked_up = F.filter(every, lambda at: F.array_contains(repeated, F.get(hashes, at)))
        at = F.when(F.size(repeated) <= FEW_REPEATED, looked_up).otherwise(every)
        return bind(F.sort_array(F.transform(at, placed)), lambda ordered: bind(starts(ordered), lambda found: covered_words(found, width)))

    def count(hashes: Column) -> Column:
        twice = bind(F.sort_array(hashes), lambda s: F.array_distinct(F.filter(s, lambda h, i: F.coalesce(F.get(s, i - 1) == h, F.lit(False)))))
        repeats = bind(twice, lambda repeated: by_text(hashes, repeated))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(repeats)

    return bind(windows(lambda parts, i: F.xxhash64(*parts)), count)


def stop_words_found(words: Column) -> Column:
    """How many different stop words stand in the text, in lower case or with a capital."""
    known = F.array(*map(F.lit, (*STOP_WORDS, *map(str.capitalize, STOP_WORDS))))
    return F.size(F.array_distinct(F.transform(F.array_intersect(words, known), F.lower)))


def ends_open(line: Column) -> Column:
    return line.endswith(ELLIPSES[0]) | line.endswith(ELLIPSES[1])


#: How each measure is computed, from (text, words, lines); lines are those with a word.
MEASURES: dict[str, Callable[[Column, Column, Column], Column]] = {
    "n_words": lambda text, words, lines: F.size(words),
    "word_chars": lambda text, words, lines: F.length(F.array_join(words, "")),
    "n_symbols": lambda text, words, lines: occurrences(text, f"[{SYMBOLS}]"),
    "n_dup_lines": lambda text, words, lines: F.size(lines) - F.size(F.array_distinct(lines)),
    "n_repeat_words": lambda text, words, lines: repeated_words(words),
    "n_lines": lambda text, words, lines: F.size(lines),
    "n_bangs": lambda text, words, lines: occurrences(text, "!"),
    "n_letter_words": lambda text, words, lines: F.regexp_count(text, F.lit(LETTER_WORD)),
    "n_stop_words": lambda text, words, lines: stop_words_found(words),
    "n_bullet_lines": lambda text, words, lines: how_many(lines, lambda line: F.substring(F.ltrim(line, F.lit(BLANKS)), 1, 1).isin(*BULLETS)),
    "n_ellipsis_lines": lambda text, words, lines: how_many(lines, lambda line: bind(F.rtrim(line, F.lit(BLANKS)), ends_open)),
}
#: The measures that every method returns.
BASE_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def broken(rule: Rule, measures: Column) -> Column:
    value = measures[rule.measure] if rule.per is None else measures[rule.measure] * F.lit(100).cast("long")
    scale = F.lit(1).cast("long") if rule.per is None else measures[rule.per]
    bounds = []
    if rule.least is not None:
        bounds.append(value < scale * rule.least)
    if rule.most is not None:
        bounds.append(value > scale * rule.most)
    if not bounds:
        raise ValueError(f"rule {rule.name} has no limit")
    return bounds[0] if len(bounds) == 1 else bounds[0] | bounds[1]


def judge(text: Column, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE_RULES) -> Column:
    """A struct of all measures the rules name, base_failed, broken_rules (names, in the table's order) and kept."""
    named = {m for rule in (*base, *rules) for m in (rule.measure, rule.per) if m}
    if unknown := named - set(MEASURES):
        raise ValueError(f"unknown measures: {sorted(unknown)}")
    wanted = [name for name in MEASURES if name in named or name in BASE_MEASURES]

    def verdict(measures: Column) -> Column:
        base_failed = F.lit(False)
        for rule in base:
            base_failed = base_failed | broken(rule, measures)
        names = F.array_compact(F.array(*[F.when(broken(rule, measures), F.lit(rule.name)) for rule in (*base, *rules)]))
        return F.struct(*[measures[name].alias(name) for name in wanted], base_failed.alias("base_failed"), names.alias("broken_rules"),
                        (F.size(names) == 0).alias("kept"))

    def measured(whole: Column) -> Column:
        words = F.array_remove(F.split(whole, BLANK_RUN), "")
        lines = F.filter(F.split(whole, "\n"), lambda line: F.ltrim(line, F.lit(BLANKS)) != "")
        return bind(words, lambda w: bind(lines, lambda ls: F.struct(*[MEASURES[m](whole, w, ls).cast("long").alias(m) for m in wanted])))

    return bind(measured(F.coalesce(text, F.lit(""))), verdict)


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """doc_id, the measures, base_failed, broken_rules, kept: one row for each row of ``docs``, by its whole text.

    ``kept`` is true where neither a base rule nor one of ``rules`` is broken. A null text has no words, as an empty one: it
    fails the base. Repeated rows and null ids each keep a row of their own; an empty table gives no rows; other columns aren't
    read. A text is held with its words and lines while it is judged, whatever its length.
    """
    judged = docs.select("doc_id", judge(F.col(text), rules).alias("judged"))
    return judged.select("doc_id", "judged.*")


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their columns."""
    return docs.where(judge(F.col("text"), rules)["kept"])


def rules_sql(rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE_RULES, docs: str = "documents") -> str:
    """DuckDB SQL of the columns that the query returns: windows are rows that are counted by their text."""

    def breaks(rule: Rule) -> str:
        value, scale = (rule.measure, "1") if rule.per is None else (f"100 * {rule.measure}", rule.per)
        bounds = [f"{value} < {rule.least} * {scale}"] if rule.least is not None else []
        return " OR ".join(bounds + ([f"{value} > {rule.most} * {scale}"] if rule.most is not None else []))

    stop = ", ".join(f"'{w}', '{w.capitalize()}'" for w in STOP_WORDS)
    blank = r"[\x20\x09-\x0D]"
    count = lambda pattern: f"len(regexp_extract_all(t, '{pattern}'))"
    lines_with = lambda test: f"len(list_filter(ls, lambda x: {test}))"
    return f"""WITH s AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM {docs}),
a AS MATERIALIZED (SELECT *, regexp_extract_all(t, '{WORD}') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM s),
p AS (SELECT k, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM a)),
c AS (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS n FROM p),
r AS (SELECT k, count(DISTINCT i + j) AS n_repeat_words FROM c, range(3) o(j) WHERE n > 1 GROUP BY k),
m AS (SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, {count("[#*$%&|<>]")} AS n_symbols,
  len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(ls) AS n_lines, {count("!")} AS n_bangs,
  len(list_filter(w, lambda x: regexp_matches(x, '\\p{{L}}'))) AS n_letter_words,
  len(list_distinct(list_transform(list_filter(w, lambda x: x IN ({stop})), lambda x: lower(x)))) AS n_stop_words,
  {lines_with(f"regexp_matches(x, '^{blank}*[-*•‣·]')")} AS n_bullet_lines, {lines_with(f"regexp_matches(x, '([.][.][.]|…){blank}*$')")} AS n_ellipsis_lines
  FROM a LEFT JOIN r USING (k))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({" OR ".join(map(breaks, base))}) AS base_failed,
  NOT ({" OR ".join(map(breaks, (*base, *rules)))}) AS kept FROM m"""
