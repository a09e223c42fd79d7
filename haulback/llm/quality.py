"""Quality rules as a short-circuit cascade, in DataFrame operations only.

Each rule's cost and share of rejections are estimated on a sample; rules then run by rejection per cost, and a
document meets a rule only if it passed all before it. The order changes the time taken, never the verdict.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulback.session import materialize

SPACES = "[\\x20\\x09-\\x0D]+"
WHITE_SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Documents on which costs and rejections are estimated, about.
SAMPLE_ROWS = 2000

#: Bounds of the rules.
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
MOST_SYMBOLS_PERCENT = 10  # per 100 words
MOST_DUP_LINES_PERCENT = 30
WORD_CHARS = (2, 20)  # mean characters of a word
LEAST_ALPHABETIC_PERCENT = 60  # words with a letter
MOST_BULLET_LINES_PERCENT = 90
MOST_ELLIPSIS_LINES_PERCENT = 30


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(WHITE_SPACE)) != "")


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, text and the counts of each row: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    A null text counts as empty: all counts are 0. Rows aren't told apart by doc_id, so repeated rows and null ids
    keep their own counts. Windows are compared by 64-bit hashes of their word hashes.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    without = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    # Neighbours are met by zipping an array with itself, shifted: a lambda that looked into the array by index would
    # work it out anew for each element wherever the optimizer moves a filter below.
    ahead = lambda name, by: F.slice(name, by + 1, F.greatest(F.size(name) - by, F.lit(0)))
    back = lambda name, by: F.slice(name, 1, F.greatest(F.size(name) - by, F.lit(0)))
    windows = docs.select("doc_id", "text", F.filter(F.split(text, SPACES, -1), lambda w: w != "").alias("words"))
    windows = windows.select("doc_id", "text", F.size("words").cast("long").alias("n_words"), F.transform("words", lambda w: F.xxhash64(w)).alias("span"))
    for by in (1, 2, 4):  # hashes of 2, 4, 8 words
        windows = windows.withColumn("span", F.zip_with(back("span", by), ahead("span", by), lambda a, b: F.xxhash64(a, b)))
    # only texts that repeat a window are sorted
    repeats = F.size(F.array_distinct("span")) < F.size("span")
    placed = F.array_sort(F.transform("span", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    placed = windows.select("doc_id", "text", "n_words", F.when(repeats, placed).alias("placed"))
    equal = F.zip_with(back("placed", 1), ahead("placed", 1), lambda a, b: a["h"] == b["h"])
    placed = placed.withColumn("equal", equal)
    no = F.array(F.lit(False))
    twice = F.zip_with(F.concat("equal", no), F.concat(no, "equal"), lambda a, b: a | b)
    at = F.zip_with("placed", twice, lambda x, t: F.when(t, x["p"]))
    found = placed.select("doc_id", "text", "n_words", F.array_sort(F.filter(at, lambda p: p.isNotNull())).alias("at"))
    covered = F.zip_with(back("at", 1), ahead("at", 1), lambda a, b: F.least(F.lit(WINDOW), b - a))
    lines = _lines(text)
    return found.select(
        "doc_id", "text", "n_words",
        F.length(F.translate(text, WHITE_SPACE, "")).cast("long").alias("word_chars"),
        without(SYMBOLS).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.when(F.col("at").isNull(), 0).otherwise(WINDOW + F.aggregate(covered, F.lit(0), lambda a, b: a + b)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def rules() -> dict[str, Column]:
    """Whether a document that passed the base fails, by rule, over the columns of :func:`base_counts`."""
    text, lines = F.col("text"), _lines(F.col("text"))
    percent_of_lines = lambda pattern, most: 100 * F.size(F.filter(lines, lambda x: F.rlike(x, F.lit(pattern)))) > most * F.size(lines)
    return {
        "symbols": 100 * F.col("n_symbols") > MOST_SYMBOLS_PERCENT * F.col("n_words"),
        "dup_lines": 100 * F.col("n_dup_lines") > MOST_DUP_LINES_PERCENT * F.size(lines),
        "word_chars": ~(F.col("word_chars") / F.col("n_words")).between(*WORD_CHARS),
        "alphabetic": 100 * F.regexp_count(text, F.lit("\\p{L}[^\\x20\\x09-\\x0D]*")) < LEAST_ALPHABETIC_PERCENT * F.col("n_words"),
        "bullet_lines": percent_of_lines("^[\\x20\\x09-\\x0D]*[-*•●◦]", MOST_BULLET_LINES_PERCENT),
        "ellipsis_lines": percent_of_lines("(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*\\z", MOST_ELLIPSIS_LINES_PERCENT),
    }


def rule_order(docs: DataFrame) -> list[str]:
    """The rules by rejections per second, both measured on a sample chosen by hash; ties by name."""
    share = min(1.0, SAMPLE_ROWS / max(1, docs.count()))
    chosen = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < F.lit(round(share * 1_000_000))
    sample = materialize(base_counts(docs.select("doc_id", "text").filter(chosen)), "quality-sample").filter(~base_failed())
    made = rules()
    rejected = sample.agg(*[F.sum(F.when(r, 1).otherwise(0)).alias(k) for k, r in made.items()]).first()
    merit = {}
    for name, rule in made.items():
        start = time.perf_counter()
        sample.agg(F.sum(F.when(rule, 1))).first()
        merit[name] = (rejected[name] or 0) / (time.perf_counter() - start)
    return sorted(made, key=lambda name: (-merit[name], name))


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, and ``rule``: the first rule that a dropped document failed.

    Every input row comes back once; other columns aren't read.
    """
    verdict = F.when(base_failed(), "base")
    made = rules()
    for name in rule_order(docs):
        verdict = verdict.when(F.coalesce(made[name], F.lit(False)), name)
    return base_counts(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), verdict.isNull().alias("kept"), verdict.alias("rule"))


#: The contract's rows for DuckDB, all rules in one expression.
ORACLE_SQL = rf"""
with texts as (
    select doc_id, coalesce(text, '') as body, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
    from documents),
places as (select doc_id, words, unnest(range(len(words) - {WINDOW - 1})) as pos from texts where len(words) >= {WINDOW}),
windows as (select doc_id, pos, array_to_string(words[pos + 1 : pos + {WINDOW}], ' ') as span from places),
found as (select doc_id, pos from windows join (select doc_id, span from windows group by doc_id, span having count(*) > 1) using (doc_id, span)),
followed as (select doc_id, pos, lead(pos) over (partition by doc_id order by pos) as next_pos from found),
repeated as (select doc_id, sum(least({WINDOW}, coalesce(next_pos - pos, {WINDOW})))::bigint as n from followed group by doc_id),
counted as (
    select doc_id, words, lines, len(words)::bigint as n_words,
           length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
           length(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
           (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(repeated.n, 0)::bigint as n_repeat_words
    from texts left join repeated using (doc_id)),
judged as (
    select *, n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words as base_failed from counted)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and 100 * n_symbols <= {MOST_SYMBOLS_PERCENT} * n_words and 100 * n_dup_lines <= {MOST_DUP_LINES_PERCENT} * len(lines)
       and word_chars / n_words between {WORD_CHARS[0]} and {WORD_CHARS[1]}
       and 100 * len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}'))) >= {LEAST_ALPHABETIC_PERCENT} * n_words
       and 100 * len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•●◦]'))) <= {MOST_BULLET_LINES_PERCENT} * len(lines)
       and 100 * len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*\z'))) <= {MOST_ELLIPSIS_LINES_PERCENT} * len(lines) as kept
from judged
"""
