"""Line dedup by content-defined chunks of lines and by passages.

A rolling hash over the hashes of two neighbouring lines decides where a chunk
ends, so boundaries depend on nearby lines only and an insertion shifts no
others. Chunks of two or more lines with words that occur again anywhere in the
corpus (or in the same text) are removed, the first occurrence (smallest id, then
place) stays. Occurrences are found by 64-bit hash and confirmed by comparing
their bytes; if two different chunks ever share a hash, all of them stay.

Chunks miss the lines between a passage's rim and its first and last boundary,
and all chunks of one line. With ``min_words``, each line with words also begins
one window and ends another: the shortest run of lines that holds so many words.
Windows depend on their own lines only, and those inside a run of that size cover
it. So besides the repeated chunks exactly the lines go that stand in a run of
one or more lines and ``min_words`` words that occurs earlier as well. Lines
without words are passed over by windows, and inside one go with it.
Windows are compared by two 64-bit hashes of different seeds, not by their bytes.

Only DataFrame functions. Per chunk or window the corpus pass keeps the smallest
and largest text or second hash and the first place, combined before the shuffle,
so a passage that a third of all documents share costs one row per task. No
occurrence list is gathered; the removals reach their documents by key.

Defined results: null text stays null and counts no lines; empty text has one
empty line; rows that repeat an id and a text count as one place and keep the
same lines; extra columns are kept, clashing ones replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentlake.llm._columns import let
from incidentlake.llm._stored import stored

MEAN_CHUNK_LINES = 3
MIN_CHUNK_LINES = 2
PASSAGE_WORDS = 50
_ADDED = ("n_lines", "n_removed_lines")
_WORD = r"[^\x20\x09-\x0D]+"


def _has_word(line: Column) -> Column:
    """The search ends at the first word."""
    return line.rlike(_WORD)


def _count_words(line: Column) -> Column:
    """Where blanks alone part words, a plain split is cheaper than the pattern."""
    return F.when(line.rlike(r"[\x09-\x0D]"), F.regexp_count(line, F.lit(_WORD))).otherwise(F.size(F.array_remove(F.split(line, " "), "")))


def _ends(lines: Column, mean_lines: int) -> Column:
    """Number of the last line of each chunk, from 1."""

    def ends(h: Column) -> Column:
        rolled = lambda i: F.pmod(F.xxhash64(F.get(h, i - 2), F.get(h, i - 1)), F.lit(mean_lines))
        return F.filter(F.sequence(F.lit(1), F.size(h)), lambda i: (i == F.size(h)) | ((i > 1) & (rolled(i) == 0)))

    return let(F.transform(lines, lambda x: F.xxhash64(x)), ends)


def chunk_spans(lines: Column, mean_lines: int = MEAN_CHUNK_LINES) -> Column:
    """Spans (``start`` and ``end``, line numbers from 0; ``hash``, ``check``,
    ``body``) of the chunks with two or more lines with words. A chunk ends after
    a line whose hash, rolled with that of the line before, is 0 modulo
    ``mean_lines``."""

    def cut(e: Column) -> Column:
        start = lambda k: F.coalesce(F.get(e, k - 1), F.lit(0))
        return F.transform(e, lambda end, k: F.struct(start(k).alias("start"), (end - 1).alias("end"), F.slice(lines, start(k) + 1, end - start(k)).alias("lines")))

    counted = F.filter(let(_ends(lines, mean_lines), cut), lambda c: F.size(F.filter(c["lines"], _has_word)) >= MIN_CHUNK_LINES)
    span = lambda c, body: F.struct(c["start"].alias("start"), c["end"].alias("end"), F.xxhash64(body).alias("hash"), F.lit(0).cast("long").alias("check"), body.alias("body"))
    return F.transform(counted, lambda c: let(F.array_join(c["lines"], "\n"), lambda body: span(c, body)))


def window_spans(lines: Column, min_words: int = PASSAGE_WORDS) -> Column:
    """Spans of the shortest runs of lines with ``min_words`` words that begin or
    end with each line with words."""
    seen = F.transform(lines, lambda x, i: F.struct(i.alias("at"), _count_words(x).alias("n"), F.xxhash64(x).alias("h"), F.xxhash64(F.lit(1), x).alias("g")))

    def reach(n: Column) -> Column:
        """For each line, how many lines from it hold so many words, or null.
        The sum counts words in its lower half and lines in its upper one."""
        words = lambda acc: acc.bitwiseAND(F.lit((1 << 32) - 1))
        add = lambda acc, x: F.when(words(acc) >= min_words, acc).otherwise(acc + x + F.lit(1 << 32))
        total = lambda k: F.aggregate(F.slice(n, k + 1, min_words), F.lit(0).cast("long"), add)
        return F.transform(n, lambda _, k: let(total(k), lambda t: F.when(words(t) >= min_words, F.shiftright(t, 32).cast("int"))))

    def of_worded(worded: Column) -> Column:
        pair = lambda a, b: F.shiftleft(a.cast("long"), 32).bitwiseOR(b.cast("long"))

        def bounds(n: Column) -> Column:
            ahead = F.transform(reach(n), lambda r, k: pair(k, k + r - 1))
            back = F.transform(reach(F.reverse(n)), lambda r, k: pair(F.size(n) - k - r, F.size(n) - 1 - k))
            present = lambda a: F.filter(a, lambda x: x.isNotNull())
            return F.array_union(present(ahead), present(back))

        def hashed(h: Column, g: Column) -> Column:
            def span(w: Column) -> Column:
                a, b = F.shiftright(w, 32).cast("int"), w.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
                part = lambda x: F.xxhash64(F.slice(x, a + 1, b - a + 1))
                line = lambda k: F.get(worded, k)["at"]
                return F.struct(line(a).alias("start"), line(b).alias("end"), part(h).alias("hash"), part(g).alias("check"), F.lit(None).cast("string").alias("body"))

            return F.transform(let(F.transform(worded, lambda s: s["n"].cast("long")), bounds), span)

        return let(F.transform(worded, lambda s: s["h"]), lambda h: let(F.transform(worded, lambda s: s["g"]), lambda g: hashed(h, g)))

    return let(F.filter(seen, lambda s: s["n"] > 0), of_worded)


def placed_spans(docs: DataFrame, text: str, doc_id: str, mean_lines: int, min_words: int | None) -> DataFrame:
    """One row per chunk and window of each text: the text's key, the place, the
    last line and the span's hashes."""

    def spans(lines: Column) -> Column:
        found = chunk_spans(lines, mean_lines)
        return found if min_words is None else F.concat(found, window_spans(lines, min_words))

    cut = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("__id"), F.xxhash64(text).alias("__text"), F.explode(let(F.split(F.col(text), "\n"), spans)).alias("s"))
    return cut.select("__id", "__text", F.struct(F.col("__id").alias("id"), F.col("s.start").alias("place")).alias("at"), F.col("s.end").alias("end"), "s.hash", "s.check", "s.body")


def repeated_spans(placed: DataFrame) -> DataFrame:
    """One row per repeated chunk or window: its hash and the place that stays."""
    ends = [f(c).alias(f"{n}_{c}") for c in ("check", "body") for n, f in (("low", F.min), ("high", F.max))]
    same = F.col("low_check").eqNullSafe(F.col("high_check")) & F.col("low_body").eqNullSafe(F.col("high_body"))
    return placed.groupBy("hash").agg(F.min("at").alias("first"), F.max("at").alias("last"), *ends).where((F.col("first") != F.col("last")) & same).select("hash", "first")


def drop_repeated_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", mean_lines: int = MEAN_CHUNK_LINES, min_words: int | None = None) -> DataFrame:
    """``docs`` with the lines of repeated chunks gone from the text, with
    ``min_words`` also those of repeated runs of so many words, and with
    ``n_lines`` (before) and ``n_removed_lines``."""
    names = [c for c in docs.columns if c.lower() not in _ADDED]
    docs = docs.select(*(F.col(f"`{c}`") for c in names))
    placed = placed_spans(docs, text, doc_id, mean_lines, min_words)
    repeated = stored(repeated_spans(placed), "line-chunks")
    gone = (
        placed.select("__id", "__text", "at", "end", "hash").join(repeated, "hash").where(~F.col("at").eqNullSafe(F.col("first")))
        .groupBy("__id", "__text").agg(F.collect_set(F.struct(F.col("at.place").alias("start"), "end")).alias("__gone"))
    )
    joined = docs.join(gone, F.col(doc_id).eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(text)) == F.col("__text")), "left")
    joined = joined.withColumn("__all", F.split(F.col(text), "\n"))  # not before the join, whose shuffle would hold each text twice
    out = F.array_distinct(F.flatten(F.transform("__gone", lambda g: F.sequence(g["start"], g["end"]))))
    stay = F.array_except(F.sequence(F.lit(0), F.size("__all") - 1), out)
    joined = joined.withColumn("__kept", F.when(F.col("__gone").isNull(), F.col("__all")).otherwise(F.transform(stay, lambda i: F.get("__all", i))))
    n = F.when(F.col(text).isNull(), 0).otherwise(F.size("__all"))
    left = F.when(F.col(text).isNull(), 0).otherwise(F.size("__kept"))
    sized = joined.withColumns({"n_lines": n.cast("long"), "n_removed_lines": (n - left).cast("long")})
    clean = F.when(F.col("__gone").isNull(), F.col(text)).otherwise(F.array_join("__kept", "\n"))
    return sized.withColumn(text, clean).select(*(F.col(f"`{c}`") for c in names), "n_lines", "n_removed_lines")
