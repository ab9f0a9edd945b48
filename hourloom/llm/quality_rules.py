"""Quality rules: a threshold table compiled into one Spark projection.

Each text is measured by native expressions over its array of words and its array of lines; the
rules are rows (name, measure, lower bound, upper bound) compiled into one Boolean expression per
rule. No user functions, no shuffle: a lost task only measures its own split again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import SPACE_CLASS, pinned, text_of

#: Common function words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "and", "of", "to", "in", "is", "that", "for", "with", "was", "are", "as", "be", "by", "it", "on", "or",
    "der", "die", "das", "und", "nicht", "mit", "den", "ein", "eine", "zu", "auf", "ist", "von", "sich",
    "le", "la", "les", "des", "et", "un", "une", "en", "que", "qui", "pour", "par", "est", "du",
    "el", "los", "las", "y", "una", "se", "por", "con", "para", "lo", "al", "del", "de", "a",
)


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie within [least, most]; None leaves a side open."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None

    def passes(self) -> Column:
        ok = F.lit(True)
        if self.least is not None:
            ok = ok & (F.col(self.measure) >= F.lit(self.least))
        if self.most is not None:
            ok = ok & (F.col(self.measure) <= F.lit(self.most))
        return ok


#: Production thresholds. Ratios are per word or per line, so they hold at any length.
RULES = (
    Rule("words_enough", "n_words", least=50),
    Rule("word_length", "mean_word_chars", least=2.0, most=14.0),
    Rule("symbols_few", "symbol_ratio", most=0.1),
    Rule("stop_words_present", "stop_ratio", least=0.02),
    Rule("lines_repeated_few", "dup_line_ratio", most=0.5),
    Rule("bullets_few", "bullet_line_ratio", most=0.9),
    Rule("ellipses_few", "ellipsis_line_ratio", most=0.3),
    Rule("words_repeated_few", "repeat_ratio", most=0.5),
)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the counts (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and the
    ratios that the rules read."""
    words = F.array_remove(F.split("t", SPACE_CLASS + "+"), "")
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = docs.select(F.col(id_col), text_of(text_col).alias("t")).select(
        id_col, words.alias("w"), lines.alias("l"), F.regexp_count("t", F.lit(r"[#*$%&|<>]")).alias("n_symbols"))
    # each three-word window as "a b c<tab>start": sorted, equal windows stand side by side
    windows = F.when(F.size("w") >= 3, F.transform(
        F.slice("w", F.lit(1), F.greatest(F.size("w") - 2, F.lit(0))),
        lambda x, i: F.concat(x, F.lit(" "), F.get("w", i + 1), F.lit(" "), F.get("w", i + 2))))
    base = base.withColumn("g", windows)
    repeated = F.size("g") != F.size(F.array_distinct("g"))
    base = base.withColumn("s", F.when(repeated, F.sort_array(F.transform(
        "g", lambda x, i: F.concat(x, F.lit("\t"), F.lpad(i.cast("string"), 10, "0")))))).drop("g")

    def key(i: Column) -> Column:
        return F.substring_index(F.get("s", i), "\t", 1)

    starts = F.transform(
        F.filter("s", lambda x, i: (F.substring_index(x, "\t", 1) == key(i + 1))
                 | (F.substring_index(x, "\t", 1) == key(i - 1))),
        lambda x: F.substring_index(x, "\t", -1).cast("int"))
    base = base.withColumn("p", F.sort_array(starts)).drop("s")
    covered = F.aggregate(
        "p", F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda acc, x: F.struct((acc["n"] + F.least(F.lit(3), x - acc["last"])).alias("n"), x.alias("last")),
        lambda acc: acc["n"])
    counted = pinned(base, [id_col], [
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.filter("w", lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size("l").cast("long").alias("n_lines"),
        F.size(F.filter("l", lambda x: x.rlike(r"^\s*(?:[-*•]\s|\d+[.)]\s)"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter("l", lambda x: x.rlike(r"(?:\.\.\.|…)\s*$"))).cast("long").alias("n_ellipsis_lines")])

    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)

    return counted.select(
        "*", ratio("word_chars", "n_words").alias("mean_word_chars"), ratio("n_symbols", "n_words").alias("symbol_ratio"),
        ratio("n_stop_words", "n_words").alias("stop_ratio"), ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        ratio("n_bullet_lines", "n_lines").alias("bullet_line_ratio"),
        ratio("n_ellipsis_lines", "n_lines").alias("ellipsis_line_ratio"),
        ratio("n_repeat_words", "n_words").alias("repeat_ratio"))


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Measures, base_failed, kept and failed_rules (comma-joined names, in table order) per row.

    base_failed: fewer than 50 words, or over half the words in repeated three-word windows. kept:
    not base_failed and every rule passes. A null text has no words, so it fails; a null id stays
    null; repeated rows give repeated results; other columns are left out; no rows give no rows.
    """
    failed = F.array_join(F.filter(F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in rules])
                                   if rules else F.array().cast("array<string>"), lambda x: x.isNotNull()), ",")
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = measures(docs, id_col, text_col)
    return out.select("*", base_failed.alias("base_failed"), failed.alias("failed_rules")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))
