"""Quality rules: a threshold table compiled into one Spark projection.

``RULES`` names a measure, a lower and an upper bound; ``apply_rules`` turns the
table into plain column expressions (no user functions, no shuffle): lengths,
symbol, stop-word and line ratios, a flag per rule and the verdict.

Words are runs of ``[^\\x20\\x09-\\x0D]``. Defined results: null and empty texts
have no words and fail the base rules; ratios over nothing are 0; very long
texts are measured whole (every step is linear or sorts); repeated rows give
repeated results; extra columns are kept, clashing ones replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentlake.llm._columns import let

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
_SYMBOLS = r"[#*$%&|<>]"

# Frequent function words of the four languages of the corpus; they
# count as written here or capitalised.
STOP_WORDS = (
    "the of and to in is that for with on as are was be by this from it at or an a "
    "de la le les des et en un une du que pour dans qui sur pas avec au "
    "der die und den von zu das mit sich des auf ist im dem nicht ein eine als "
    "el los las del por con para se su al lo como una y"
).split()

# Rules of the method: (name, measure, lowest, highest); None is unbounded.
RULES = (
    ("word_length", "mean_word_chars", 1.5, 40.0),
    ("symbols", "symbol_ratio", None, 0.5),
    ("stop_words", "stop_ratio", 0.01, None),
    ("duplicate_lines", "dup_line_ratio", None, 0.5),
)


def _repeated_words(words: Column) -> Column:
    """Words covered by 8-word windows that occur twice or more in the text.

    Windows are compared by 64-bit hash. Texts without a repeated window (a hash
    set tells) stop there; for the others, (hash, place) pairs are sorted, places
    next to an equal hash are kept, sorted again, and each covers the words up to
    the next kept place, eight at most."""
    n = F.size(words) - (WINDOW - 1)

    def doubled(hashes: Column) -> Column:
        """Window hashes from word hashes: pairs, pairs of pairs, and so on."""
        pair = lambda a, k: F.transform(a, lambda x, i: F.xxhash64(x, F.get(a, i + k)))
        return let(pair(hashes, 1), lambda two: let(pair(two, 2), lambda four: F.slice(pair(four, 4), 1, F.size(four) - (WINDOW - 1))))

    windows = let(F.transform(words, lambda w: F.xxhash64(w)), doubled)

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def neighbour(pairs: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(pairs, k)["h"] == x["h"], F.lit(False))
            twice = F.filter(pairs, lambda x, k: same(x, k - 1) | same(x, k + 1))
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        def total(places: Column) -> Column:
            steps = F.transform(places, lambda p, k: F.least(F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
            return F.aggregate(steps, F.lit(0), lambda s, x: s + x)

        return let(placed, lambda p: let(neighbour(p), total))

    repeated = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h))
    return F.when(n > 1, let(windows, repeated)).otherwise(0)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base counts and the ratios that the rules look at."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = F.array_remove(F.split(body, r"[\x20\x09-\x0D]+"), "")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    stop = sorted({*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)})
    first = {"__words": words, "__lines": lines, "n_symbols": F.regexp_count(body, F.lit(_SYMBOLS)).cast("long")}
    second = {
        "n_words": F.size("__words").cast("long"), "n_lines": F.size("__lines").cast("long"),
        "word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": _repeated_words(F.col("__words")).cast("long"),
        "n_stop_words": F.size(F.filter("__words", lambda w: w.isin(*stop))).cast("long"),
    }
    third = {
        "mean_word_chars": ratio(F.col("word_chars"), F.col("n_words")), "symbol_ratio": ratio(F.col("n_symbols"), F.col("n_words")),
        "stop_ratio": ratio(F.col("n_stop_words"), F.col("n_words")), "dup_line_ratio": ratio(F.col("n_dup_lines"), F.col("n_lines")),
    }
    return docs.withColumns(first).withColumns(second).withColumns(third).drop(*(c for c in first if c.startswith("__")))


def compile_rules(rules=RULES) -> dict[str, Column]:
    """Rule name -> column that is true where the rule is broken."""
    flags = {}
    for name, measure, low, high in rules:
        out = F.lit(False)
        if low is not None:
            out = out | (F.col(measure) < low)
        if high is not None:
            out = out | (F.col(measure) > high)
        flags[name] = out
    return flags


def apply_rules(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """``docs`` with all measures, ``base_failed``, ``failed_rules`` (names of
    the broken rules) and ``kept``."""
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    flags = compile_rules(rules)
    broken = F.filter(F.array(*(F.when(c, F.lit(k)) for k, c in flags.items())), lambda x: x.isNotNull())
    return (
        measured(docs, text).withColumns({"base_failed": base, "failed_rules": broken})
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    )
