"""Operator 2: quality rules and cross-document line frequency, DataFrame functions only.

Lines are normalised and hashed; for every host the distinct documents that
hold a line are counted; lines above the limit are removed from the host's
documents, and a document that is left depleted is rejected.  Before that each
document's own statistics must pass the base rules.  Only hashes, counts and
keys are shuffled, never text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm._store import materialize, without

#: Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 10, 5, 20
SPLIT = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
OUT = (*STATS, "base_failed", "kept", "n_removed_words", "text_kept")
_ID, _BASE = "__line_doc", "__line_base"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once even if ``body`` uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _has_word(line: Column) -> Column:
    return F.length(F.translate(line, SPACE, "")) > 0


def word_list(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    return F.filter(F.split(text, SPLIT), lambda w: w != "")


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a ``window``-word sequence which occurs twice or more in ``words``.

    Windows are compared by 64-bit hash.  Most texts have no repeat, which a
    distinct count of the hashes tells; otherwise hashes are sorted with their
    positions, so that equal ones are neighbours, and the covered words are
    summed over the gaps between the repeated windows' starts.
    """
    def covered(h: Column) -> Column:
        at = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        starts = _let(at, lambda a: F.array_sort(F.transform(F.filter(a, lambda x, k: (
            F.coalesce(F.get(a, k - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(a, k + 1)["h"] == x["h"], F.lit(False)))), lambda x: x["i"])))
        return _let(starts, lambda s: F.aggregate(
            F.transform(s, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(s, k + 1) - x, F.lit(window)))),
            F.lit(0), lambda a, x: a + x))

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - window),
                           lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))

    return F.when(F.size(words) < window, F.lit(0)).otherwise(
        _let(words, lambda w: _let(windows(w), lambda h: F.when(
            F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))))


def base_stats(text: Column) -> Column:
    """Struct of the contract's word, symbol, line and repetition counts and the base verdict."""
    spaced = F.translate(text, SPACE, "")
    lines = F.filter(F.split(text, "\n"), _has_word)

    def from_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w).cast("long").alias("n_repeat_words"))

    counted = _let(word_list(text), from_words)
    duplicates = _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    return F.struct(counted.alias("words"), F.length(spaced).cast("long").alias("word_chars"),
                    (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                    duplicates.alias("n_dup_lines"))


def normal_line(line: Column) -> Column:
    """A-Z lower-cased, white space trimmed and runs of it made one space."""
    return F.btrim(F.regexp_replace(F.translate(line, UPPER, LOWER), SPLIT, " "))


def line_hash(line: Column) -> Column:
    return F.xxhash64(normal_line(line))


def line_rows(docs: DataFrame, host: str) -> DataFrame:
    """One row for each different line of each different document: host, document key, hash, words in all its places (of all copies)."""
    lines = F.filter(F.split(F.coalesce(F.col("text"), F.lit("")), "\n"), _has_word)
    return (docs.select(F.col(host).alias("host"), _doc_key().alias(_ID), F.explode(lines).alias("line"))
            .select("host", _ID, F.xxhash64(normal_line(F.col("line"))).alias("h"), F.size(word_list(F.col("line"))).cast("long").alias("n"))
            .groupBy("host", "h", _ID).agg(F.sum("n").alias("n")))


def _doc_key() -> Column:
    """Equal for rows that agree in doc_id and text, which count as one document."""
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def judge_lines(docs: DataFrame, host: str = "source", min_docs: int = 20, max_percent: int = 2,
                min_left_percent: int = 30) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, ``host``, any others) with its statistics, verdict and cleaned text.

    A line is above the limit if it stands in at least ``min_docs`` different
    documents of its host and in more than ``max_percent`` of them.  A document
    is kept if it passes the base rules and the lines left hold at least
    10 words and ``min_left_percent`` of its words.  ``text_kept`` is the
    text without the removed lines; ``n_removed_words`` counts their words.

    Null text has no words and fails the base rules.  Null hosts are one
    host.  Rows that repeat both doc_id and text count as one document and get
    the same verdict.  Input columns named like an output are replaced.  An
    empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = (without(docs, *OUT).withColumn(_ID, _doc_key()).withColumn("__line_host", F.col(host))
            .withColumn(_BASE, base_stats(text)))
    # Written, so that lines are split and hashed once.
    rows = materialize(line_rows(docs, host), "document-lines")
    # Rows that repeat a document are one; their lines were summed over all of them.
    copies = docs.select(F.col(host).alias("host"), _doc_key().alias(_ID)).groupBy("host", _ID).agg(F.count("*").alias("copies"))
    hosts = copies.groupBy("host").agg(F.count("*").alias("host_docs"))
    per_line = rows.groupBy("host", "h").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs)
    frequent = (per_line.alias("l").join(hosts.alias("t"), F.col("l.host").eqNullSafe(F.col("t.host")))
                .where(100 * F.col("docs") > max_percent * F.col("host_docs"))
                .select(F.col("l.host").alias("f_host"), F.col("h").alias("f_h")))
    # Few lines of a document are frequent, and it has a bounded number of lines.
    found = (rows.join(frequent, rows.host.eqNullSafe(frequent.f_host) & (rows.h == frequent.f_h))
             .groupBy("host", _ID).agg(F.sum("n").alias("words"), F.collect_list("h").alias("__line_bad")))
    removed = (found.alias("r").join(copies.alias("c"), F.col("r.host").eqNullSafe(F.col("c.host")) & (F.col(f"r.{_ID}") == F.col(f"c.{_ID}")))
               .select(F.col("r.host").alias("__line_r_host"), F.col(f"r.{_ID}").alias("__line_r_doc"),
                       F.expr("words div copies").alias("__line_gone"), "__line_bad"))
    joined = base.join(removed, (base[_ID] == F.col("__line_r_doc")) & base["__line_host"].eqNullSafe(F.col("__line_r_host")), "left")
    n_words, repeat = F.col(_BASE)["words"]["n_words"], F.col(_BASE)["words"]["n_repeat_words"]
    gone = F.coalesce(F.col("__line_gone"), F.lit(0))
    left = n_words - gone
    failed = (n_words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n_words)
    kept_lines = F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(F.col("__line_bad"), line_hash(x)))
    return joined.select(
        *without(docs, *OUT).columns,
        n_words.alias("n_words"), F.col(_BASE)["word_chars"].alias("word_chars"), F.col(_BASE)["n_symbols"].alias("n_symbols"),
        F.col(_BASE)["n_dup_lines"].alias("n_dup_lines"), repeat.alias("n_repeat_words"), failed.alias("base_failed"),
        (~failed & (left >= MIN_WORDS) & (100 * left >= min_left_percent * n_words)).alias("kept"),
        gone.alias("n_removed_words"),
        F.when(F.col("__line_bad").isNull(), text).otherwise(F.array_join(kept_lines, "\n")).alias("text_kept"))
