"""Quality rules, line first: bad lines go, then documents that lost too much text.

Every step is a built-in column expression, so a document never leaves its row and nothing is shuffled.

A line with a word is dropped when one of these holds (``line_fails``):

* punctuation: more than ``SYMBOL_SHARE`` % of its characters are of ``[#*$%&|<>]``, or it
  has at least 4 exclamation marks and more than one for every two words;
* navigation: at least two vertical bars between blanks, or up to 4 words without an end mark that
  start with one of the menu words;
* boilerplate: it holds one of the fixed page phrases;
* repetition: of at least 6 words, fewer than ``DISTINCT_SHARE`` % are distinct;
* it equals an earlier line of the document.

A document is kept when it passes the base rules and the lines left hold at least ``KEEP_SHARE`` %
of its word characters.

Defined results: a null or empty text has no words and fails the base rules; repeated rows give
repeated results; an empty table gives an empty result; other columns are ignored. Three-word windows are
compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = r"[ \t\n\x0B\f\r]+"
MIN_WORDS = 50
REPEAT_SHARE = 50
SYMBOL_SHARE = 10
DISTINCT_SHARE = 30
KEEP_SHARE = 50
END_MARK = r"[.!?:;…][\"')\]]*[ \t\x0B\f\r]*$"
MENU = r"^[ \t]*(Home|Menu|Login|Sign in|Sign up|Next|Previous|Back|Share|Search|Contact|About)( |$)"
#: In lower case.
PHRASES = ("lorem ipsum", "cookie policy", "privacy policy", "terms of use", "all rights reserved", "enable javascript")
#: Documents of more windows than this are looked at with two hash layouts.
ONE_LAYOUT = 4096


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once for a row however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shift(way: str, value: Column, bits: Column) -> Column:
    return F.call_function(f"shift{way}", value, bits)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def count_of(text: Column, keep: str) -> Column:
    """Characters of ``text`` in the class ``keep``."""
    return F.length(F.regexp_replace(text, f"[^{keep}]+", ""))


def repeated_words(words: Column) -> Column:
    """Words that lie in a three-word window found at least twice, the first finding included."""

    def positions(windows: Column, turn: int) -> Column:
        # Hash bits above, the position below: one sort of plain longs brings equal windows together.
        def packed(bits: Column) -> Column:
            high = lambda h: shift("left", shift("rightunsigned", h, bits), bits)
            turned = lambda h: shift("left", h, F.lit(turn)).bitwiseOR(shift("rightunsigned", h, F.lit(64 - turn)))
            own = F.transform(windows, lambda h, i: high(turned(h) if turn else h).bitwiseOR(i.cast("bigint")))
            return let(F.sort_array(own), lambda s: equal(s, bits))

        def equal(s: Column, bits: Column) -> Column:
            # Neighbours that differ below the hash bits only.
            same = lambda a, b: shift("rightunsigned", a.bitwiseXOR(b), bits) == 0
            after = F.zip_with(s, F.slice(s, 2, F.size(s) - 1), same)
            low = shift("left", F.lit(1).cast("bigint"), bits) - 1

            def found(met: Column) -> Column:
                at = lambda i: F.coalesce(F.get(met, i), F.lit(False))
                return F.transform(F.filter(s, lambda _, i: at(i) | at(i - 1)), lambda x: x.bitwiseAND(low))

            return let(after, found)

        return F.sort_array(let(F.length(F.bin(F.size(windows).cast("bigint"))), packed))

    def covered(found: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).cast("bigint").alias("last"))
        step = lambda a, p: F.struct((a["n"] + F.least(F.lit(3).cast("bigint"), p - a["last"])).alias("n"), p.alias("last"))
        return F.aggregate(found, start, step, lambda a: a["n"])

    def count(windows: Column) -> Column:
        both = lambda: F.sort_array(F.array_intersect(positions(windows, 0), positions(windows, 31)))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint")).otherwise(
            covered(F.when(F.size(windows) <= ONE_LAYOUT, positions(windows, 0)).otherwise(both()))
        )

    def windows(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - 3)
        return F.transform(at, lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)))

    many = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(windows(h), count))
    return F.when(F.size(words) < 3, F.lit(0).cast("bigint")).otherwise(many)


def line_fails(line: Column) -> Column:
    def fails(words: Column) -> Column:
        n = F.size(words)
        shouts = count_of(line, "!")
        phrase = F.lit(False)
        for p in PHRASES:
            phrase = phrase | F.lower(line).contains(p)
        return (
            (count_of(line, "#*$%&|<>") * 100 > F.length(line) * SYMBOL_SHARE)
            | (line.contains("!") & (shouts >= 4) & (shouts * 2 > n))
            | (line.contains("|") & line.rlike(r" \| .* \| "))
            | ((n <= 4) & line.rlike(MENU) & ~line.rlike(END_MARK))
            | ((n >= 6) & (F.size(F.array_distinct(words)) * 100 < n * DISTINCT_SHARE))
            | phrase
        )

    return let(words_of(line), fails)


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, the base counts, base_failed, kept_chars, kept and the cleaned text."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^ \t\n\x0B\f\r]"))
    own = rows.select(
        "doc_id",
        let(
            words_of(F.col("text")),
            lambda w: F.struct(
                F.size(w).cast("bigint").alias("n_words"),
                F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
                repeated_words(w).alias("n_repeat_words"),
            ),
        ).alias("of_words"),
        count_of(F.col("text"), "#*$%&|<>").cast("bigint").alias("n_symbols"),
        let(
            lines,
            lambda ls: let(
                F.array_distinct(ls),
                lambda once: F.struct(
                    (F.size(ls) - F.size(once)).cast("bigint").alias("n_dup_lines"),
                    F.array_join(F.filter(once, lambda line: ~line_fails(line)), "\n").alias("cleaned"),
                ),
            ),
        ).alias("of_lines"),
    ).select("doc_id", "of_words.*", "n_symbols", "of_lines.*")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_SHARE)
    kept_chars = F.length(F.regexp_replace("cleaned", BLANKS, "")).cast("bigint")
    return (
        own.withColumn("base_failed", failed)
        .withColumn("kept_chars", kept_chars)
        .withColumn("kept", ~F.col("base_failed") & (F.col("kept_chars") * 100 >= F.col("word_chars") * KEEP_SHARE))
    )


def verdicts(docs: DataFrame) -> DataFrame:
    return clean_lines(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


#: The same rows in DuckDB's SQL.
VERDICTS_SQL = rf"""
WITH t AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, row_number() OVER () AS k, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, list_filter(string_split_regex(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines
  FROM t
), win AS (
  SELECT k, p, count(*) OVER (PARTITION BY k, a, b, c) AS n
  FROM (
    SELECT k, p, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c
    FROM (SELECT k, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM w)
    WINDOW o AS (PARTITION BY k ORDER BY p)
  ) WHERE c IS NOT NULL
), rep AS (
  SELECT k, count(DISTINCT p + d) AS n_repeat_words FROM win, (SELECT unnest([0, 1, 2]) AS d) WHERE n > 1 GROUP BY k
), line AS (
  SELECT DISTINCT k, unnest(lines) AS line FROM w
), kept_lines AS (
  SELECT k, sum(length(regexp_replace(line, '[ \t\n\x0B\f\r]+', '', 'g'))) AS kept_chars
  FROM (
    SELECT *, length(regexp_replace(line, '[^!]+', '', 'g')) AS shouts,
      list_filter(string_split_regex(line, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS ws, len(ws) AS n
    FROM line)
  WHERE NOT (
    length(regexp_replace(line, '[^#*$%&|<>]+', '', 'g')) * 100 > length(line) * {SYMBOL_SHARE}
    OR (shouts >= 4 AND shouts * 2 > n)
    OR regexp_matches(line, ' \| .* \| ')
    OR (regexp_matches(line, '{MENU}') AND n <= 4 AND NOT regexp_matches(line, '{END_MARK.replace("'", "''")}'))
    OR regexp_matches(lower(line), '{'|'.join(PHRASES)}')
    OR (len(ws) >= 6 AND len(list_distinct(ws)) * 100 < len(ws) * {DISTINCT_SHARE}))
  GROUP BY k
), s AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    coalesce(kept_chars, 0) AS kept_chars
  FROM w LEFT JOIN rep USING (k) LEFT JOIN kept_lines USING (k)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {REPEAT_SHARE} AS base_failed,
  NOT (n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {REPEAT_SHARE})
    AND kept_chars * 100 >= word_chars * {KEEP_SHARE} AS kept
FROM s
"""
