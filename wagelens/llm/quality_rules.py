"""Quality rules (operator 4): a threshold table compiled into one Spark projection, without user functions.

``measure`` adds one struct of exact whole-text measures per row; ``compile_rules`` turns rows of a threshold table
(measure, least, most) into one boolean column.  Everything is built-in column functions on the row itself: no
shuffle, no join, no Python on the executors, so the plan is a scan and a projection at any size.

Words are runs of ``[^\\x20\\x09-\\x0D]``.  Defined results: a null or wordless text has zeros everywhere and fails the
base rule (fewer than 20 words); null ids and repeated rows pass through, one output row per input row; other
columns of the input are neither read nor returned, so clashing names do no harm.

n_repeat_words compares 8-word windows by a 64-bit hash inside one document; positions of equal windows are found by
sorting the document's own (hash, position) pairs, so long documents cost n log n and never n^2.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8
SPACE = "[\\x20\\x09-\\x0D]"

# Common function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in a is that it on for was with be as by this are at from an or not "
    "der die das und ist von den zu mit ein eine im auf für sich des dem nicht in es "
    "le la les de des et un une que est en du pour dans par sur qui au avec ne "
    "el los las y del se por con una su para es al lo como más"
).split()


@dataclass(frozen=True)
class Rule:
    """A document passes when least <= measure <= most (either bound may be absent)."""

    measure: str
    least: float | None = None
    most: float | None = None


#: Thresholds of the method's own verdict.
RULES = (
    Rule("mean_word_chars", 1.5, 25.0),
    Rule("symbol_ratio", None, 0.5),
    Rule("stop_ratio", 0.02, None),
    Rule("dup_line_ratio", None, 0.5),
)


def _let(value: Column, body) -> Column:
    """body(value) with value computed once per row (a lambda variable instead of a repeated expression)."""
    return F.transform(F.array(value), body)[0]


def _repeated(words: Column) -> Column:
    """Number of words inside 8-word windows that occur twice or more among these words."""
    def from_hashes(hashes: Column) -> Column:
        return F.when(F.size(hashes) == F.size(F.array_distinct(hashes)), F.lit(0).cast("long")).otherwise(
            _let(F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), from_sorted))

    def from_sorted(pairs: Column) -> Column:
        last = F.size(pairs) - 1

        def equal_neighbour(x: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(pairs, i - 1)["h"] == x["h"]).otherwise(False)
            after = F.when(i < last, F.get(pairs, i + 1)["h"] == x["h"]).otherwise(False)
            return before | after
        return _let(F.array_sort(F.transform(F.filter(pairs, equal_neighbour), lambda x: x["i"])), covered)

    def covered(starts: Column) -> Column:
        step = F.transform(starts, lambda p, i: F.when(i == 0, F.lit(WINDOW)).otherwise(
            F.least(F.lit(WINDOW), p - F.get(starts, i - 1))))
        return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)

    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)),
                         lambda i: F.xxhash64(F.array_join(F.slice(words, i, WINDOW), " ")))
    return F.when(F.size(words) > WINDOW, _let(hashes, from_hashes)).otherwise(F.lit(0).cast("long"))


def measure(text: Column) -> Column:
    """Struct of the base measures and of what the threshold table may name."""
    whole = F.coalesce(text, F.lit(""))
    spaced = F.regexp_replace(whole, SPACE + "+", " ")
    words = F.filter(F.split(spaced, " ", -1), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    symbols = F.length(whole) - F.length(F.regexp_replace(whole, "[#*$%&|<>]+", ""))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
            _repeated(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long").alias("n_stop"))

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n_lines"),
                        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    return F.struct(_let(words, of_words).alias("w"), _let(lines, of_lines).alias("l"),
                    symbols.cast("long").alias("n_symbols"))


def ratios(m: Column) -> dict[str, Column]:
    """Measures a rule may name, as columns over the struct of ``measure``; null (no words) passes no bound."""
    n = F.when(m["w"]["n_words"] > 0, m["w"]["n_words"])
    return {
        "n_words": m["w"]["n_words"],
        "mean_word_chars": m["w"]["word_chars"] / n,
        "symbol_ratio": m["n_symbols"] / n,
        "stop_ratio": m["w"]["n_stop"] / n,
        "dup_line_ratio": m["l"]["n_dup_lines"] / F.when(m["l"]["n_lines"] > 0, m["l"]["n_lines"]),
        "repeat_ratio": m["w"]["n_repeat_words"] / n,
    }


def compile_rules(rules: tuple[Rule, ...], measures: dict[str, Column]) -> Column:
    """One boolean column for the whole threshold table; a measure that is null fails a rule."""
    ok = F.lit(True)
    for r in rules:
        x = measures[r.measure]
        if r.least is not None:
            ok = ok & (x >= r.least)
        if r.most is not None:
            ok = ok & (x <= r.most)
    return F.coalesce(ok, F.lit(False))


def with_quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input's columns under one struct ``doc``, with the measures ``m`` beside it."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), measure(F.col(text)).alias("m"))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the measures, base_failed and kept, one row per input row."""
    m = F.col("m")
    measured = docs.select("doc_id", measure(F.col("text")).alias("m"))
    base = (m["w"]["n_words"] < 20) | (100 * m["w"]["n_repeat_words"] > 30 * m["w"]["n_words"])
    return measured.select(
        "doc_id", m["w"]["n_words"].alias("n_words"), m["w"]["word_chars"].alias("word_chars"),
        m["n_symbols"].alias("n_symbols"), m["l"]["n_dup_lines"].alias("n_dup_lines"),
        m["w"]["n_repeat_words"].alias("n_repeat_words"), base.alias("base_failed"),
        (~base & compile_rules(rules, ratios(m))).alias("kept"))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns as they were."""
    m = F.col("m")
    base = (m["w"]["n_words"] < 20) | (100 * m["w"]["n_repeat_words"] > 30 * m["w"]["n_words"])
    good = with_quality(docs).filter(~base & compile_rules(rules, ratios(m)))
    return good.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
