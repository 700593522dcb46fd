"""License scans: ordered signature rules with keyword prefilter and suppression.

The text becomes a list of words (A-Z lower-cased; anything but digits, letters
and characters beyond ASCII separates them). A cheap keyword test on the text
lets most documents go. In the others, words that can begin a signature are
anchors; the rules of an anchor's word are tried on the words that follow it.

A rule is a pattern over words, a label, a confidence and a place in the order:
identifier tags, then grants ("licensed under the ..."), then bare names. Of the
detections with one start the first in order wins, the longer one among equals.
Of two detections one of which contains the other, the one earlier in order
stays, the longer one among equals.

The rules come from small tables: license names by form of mention, SPDX short
ids for the tag, short names that count after a grant's words only. The keyword
test is derived from the rules, one word that each of them needs. Only
DataFrame functions; every step is linear in the text.

Defined results: null counts as the empty text, which has no words; a text
without detections has empty labels and score 0.0; repeated rows give repeated
results; extra columns are kept, clashing ones replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REACH = 16  # words that a signature may span

# The base phrases and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

_V = "(?:version |v)?"
# Hand-written names, as patterns over lower-cased words: label, pattern. The
# first word is literal; it is the rule's anchor.
NAMES = (
    ("mit", "mit(?: x11)? licen[sc]e"), ("mit", "expat licen[sc]e"), ("mit-0", "mit no attribution(?: licen[sc]e)?"),
    ("apache-2.0", f"apache (?:software )?(?:licen[sc]e )?{_V}2(?: 0)?"), ("apache-1.1", f"apache (?:software )?licen[sc]e {_V}1 1"),
    ("apache", "apache (?:software )?licen[sc]e"), ("gpl-3.0", f"gnu general public licen[sc]e {_V}3(?: 0)?"),
    ("gpl-2.0", f"gnu general public licen[sc]e {_V}2(?: 0)?"), ("gpl", "gnu general public licen[sc]e"), ("gpl", "general public licen[sc]e"),
    ("gpl", "gnu gpl"), ("gpl-3.0", "gplv3"), ("gpl-2.0", "gplv2"), ("gpl-3.0", f"gpl {_V}3(?: 0)?"), ("gpl-2.0", f"gpl {_V}2(?: 0)?"),
    ("lgpl-3.0", f"gnu lesser general public licen[sc]e {_V}3(?: 0)?"), ("lgpl-2.1", f"gnu lesser general public licen[sc]e {_V}2 1"),
    ("lgpl-2.0", f"gnu library general public licen[sc]e {_V}2(?: 0)?"), ("lgpl", "gnu lesser general public licen[sc]e"),
    ("lgpl", "lesser general public licen[sc]e"), ("lgpl", "gnu lgpl"), ("lgpl-3.0", "lgplv3"), ("lgpl-2.1", f"lgpl {_V}2 1"),
    ("agpl-3.0", f"gnu affero general public licen[sc]e {_V}3(?: 0)?"), ("agpl", "gnu affero general public licen[sc]e"),
    ("agpl", "affero general public licen[sc]e"), ("agpl-3.0", "agplv3"), ("gfdl", "gnu free documentation licen[sc]e(?: version 1 [123])?"),
    ("bsd-3-clause", "bsd 3 clause(?: licen[sc]e)?"), ("bsd-2-clause", "bsd 2 clause(?: licen[sc]e)?"), ("bsd-4-clause", "bsd 4 clause(?: licen[sc]e)?"),
    ("bsd-3-clause", "new bsd licen[sc]e"), ("bsd-3-clause", "modified bsd licen[sc]e"), ("bsd-2-clause", "simplified bsd licen[sc]e"),
    ("bsd-2-clause", "freebsd licen[sc]e"), ("bsd", "bsd licen[sc]e"), ("0bsd", "zero clause bsd(?: licen[sc]e)?"), ("isc", "isc licen[sc]e"),
    ("mpl-2.0", f"mozilla public licen[sc]e {_V}2(?: 0)?"), ("mpl-1.1", f"mozilla public licen[sc]e {_V}1 1"), ("mpl", "mozilla public licen[sc]e"),
    ("epl-2.0", f"eclipse public licen[sc]e {_V}2(?: 0)?"), ("epl-1.0", f"eclipse public licen[sc]e {_V}1(?: 0)?"), ("epl", "eclipse public licen[sc]e"),
    ("cddl-1.0", f"common development and distribution licen[sc]e(?: {_V}1(?: 0)?)?"), ("cpl-1.0", f"common public licen[sc]e(?: {_V}1(?: 0)?)?"),
    ("eupl-1.2", f"european union public licen[sc]e(?: {_V}1 2)?"), ("cecill-2.1", f"cecill(?: free software)? licen[sc]e(?: {_V}2 1)?"),
    ("artistic-2.0", f"artistic licen[sc]e {_V}2(?: 0)?"), ("artistic-1.0", "artistic licen[sc]e"), ("bsl-1.0", f"boost software licen[sc]e(?: {_V}1(?: 0)?)?"),
    ("zlib", "zlib(?: libpng)? licen[sc]e"), ("unlicense", "unlicen[sc]e"), ("wtfpl", "wtfpl"), ("wtfpl", "do what the fuck you want to public licen[sc]e"),
    ("psf-2.0", "python software foundation licen[sc]e(?: version 2)?"), ("ruby", "ruby licen[sc]e"), ("php-3.01", "php licen[sc]e(?: version 3 01)?"),
    ("postgresql", "postgresql licen[sc]e"), ("openssl", "openssl licen[sc]e"), ("ofl-1.1", f"sil open font licen[sc]e(?: {_V}1 1)?"),
    ("ncsa", "university of illinois ncsa open source licen[sc]e"), ("ms-pl", "microsoft public licen[sc]e"), ("ms-rl", "microsoft reciprocal licen[sc]e"),
    ("osl-3.0", f"open software licen[sc]e(?: {_V}3(?: 0)?)?"), ("afl-3.0", f"academic free licen[sc]e(?: {_V}3(?: 0)?)?"),
    ("bsl-1.1", f"business source licen[sc]e(?: {_V}1 1)?"), ("sspl-1.0", f"server side public licen[sc]e(?: {_V}1(?: 0)?)?"),
    ("elastic-2.0", f"elastic licen[sc]e(?: {_V}2(?: 0)?)?"), ("odbl-1.0", f"open database licen[sc]e(?: {_V}1(?: 0)?)?"),
    ("odc-by-1.0", f"open data commons attribution licen[sc]e(?: {_V}1(?: 0)?)?"), ("pddl-1.0", "public domain dedication and licen[sc]e"),
    ("cc0-1.0", "cc0(?: 1 0)?(?: universal)?"), ("cc0-1.0", "creative commons zero(?: {_V}1 0)?".replace("{_V}", _V)),
    ("cc-by-nc-nd", "creative commons attribution noncommercial noderivatives(?: licen[sc]e)?"), ("cc-by-nc-sa", "creative commons attribution noncommercial sharealike(?: licen[sc]e)?"),
    ("cc-by-nc", "creative commons attribution noncommercial(?: licen[sc]e)?"), ("cc-by-nd", "creative commons attribution noderivatives(?: licen[sc]e)?"),
    ("cc-by-sa", "creative commons attribution sharealike(?: licen[sc]e)?"), ("cc-by", "creative commons attribution(?: licen[sc]e)?"),
    ("cc", "creative commons licen[sc]e"), ("cc-by-nc-nd", "cc by nc nd(?: [1234] [05])?"), ("cc-by-nc-sa", "cc by nc sa(?: [1234] [05])?"),
    ("cc-by-nc", "cc by nc(?: [1234] [05])?"), ("cc-by-nd", "cc by nd(?: [1234] [05])?"), ("cc-by-sa", "cc by sa(?: [1234] [05])?"),
    ("cc-by", "cc by(?: [1234] [05])?"), ("public-domain", "public domain"), ("proprietary", "proprietary and confidential"),
)
# SPDX short ids, as written after the tag: label, words. The longer ids of a
# family come first; "only" and "or later" may follow those of the GNU family.
SPDX_IDS = (
    ("mit-0", "mit 0"), ("mit", "mit"), ("0bsd", "0bsd"), ("bsd-2-clause", "bsd 2 clause"), ("bsd-3-clause", "bsd 3 clause"), ("bsd-4-clause", "bsd 4 clause"),
    ("isc", "isc"), ("apache-1.1", "apache 1 1"), ("apache-2.0", "apache 2 0"), ("mpl-1.1", "mpl 1 1"), ("mpl-2.0", "mpl 2 0"),
    ("gpl-2.0", "gpl 2 0"), ("gpl-3.0", "gpl 3 0"), ("lgpl-2.0", "lgpl 2 0"), ("lgpl-2.1", "lgpl 2 1"), ("lgpl-3.0", "lgpl 3 0"),
    ("agpl-3.0", "agpl 3 0"), ("gfdl", "gfdl 1 [123]"), ("epl-1.0", "epl 1 0"), ("epl-2.0", "epl 2 0"), ("cddl-1.0", "cddl 1 0"), ("cpl-1.0", "cpl 1 0"),
    ("eupl-1.2", "eupl 1 2"), ("cecill-2.1", "cecill 2 1"), ("artistic-1.0", "artistic 1 0"), ("artistic-2.0", "artistic 2 0"),
    ("bsl-1.0", "bsl 1 0"), ("bsl-1.1", "busl 1 1"), ("zlib", "zlib"), ("unlicense", "unlicense"), ("wtfpl", "wtfpl"), ("psf-2.0", "(?:psf 2 0|python 2 0)"),
    ("ruby", "ruby"), ("php-3.01", "php 3 01"), ("postgresql", "postgresql"), ("openssl", "openssl"), ("ofl-1.1", "ofl 1 1"), ("ncsa", "ncsa"),
    ("ms-pl", "ms pl"), ("ms-rl", "ms rl"), ("osl-3.0", "osl 3 0"), ("afl-3.0", "afl 3 0"), ("sspl-1.0", "sspl 1 0"), ("elastic-2.0", "elastic 2 0"),
    ("odbl-1.0", "odbl 1 0"), ("odc-by-1.0", "odc by 1 0"), ("pddl-1.0", "pddl 1 0"), ("cc0-1.0", "cc0 1 0"), ("cc-by-nc-nd", "cc by nc nd [1234] [05]"),
    ("cc-by-nc-sa", "cc by nc sa [1234] [05]"), ("cc-by-nc", "cc by nc [1234] [05]"), ("cc-by-nd", "cc by nd [1234] [05]"), ("cc-by-sa", "cc by sa [1234] [05]"), ("cc-by", "cc by [1234] [05]"),
)
_GNU_SUFFIX = "(?: only| or later)?"
# Names that mean a license only after the words of a tag or a grant.
SHORT_NAMES = (
    ("gpl", "gpl"), ("lgpl", "lgpl"), ("lgpl-2.0", f"lgpl {_V}2(?: 0)?"), ("lgpl-3.0", f"lgpl {_V}3(?: 0)?"), ("agpl", "agpl"), ("agpl-3.0", f"agpl {_V}3(?: 0)?"),
    ("mpl", "mpl"), ("mpl-1.1", f"mpl {_V}1 1"), ("mpl-2.0", f"mpl {_V}2(?: 0)?"), ("mit", "mit"), ("isc", "isc"), ("zlib", "zlib"), ("bsd", "bsd"),
    ("epl", "epl"), ("epl-1.0", f"epl {_V}1(?: 0)?"), ("epl-2.0", f"epl {_V}2(?: 0)?"), ("bsl-1.0", "bsl 1 0"), ("0bsd", "0bsd"), ("ofl-1.1", "(?:sil )?ofl(?: 1 1)?"),
)
# Abbreviations with a version, which stand for a license by themselves.
VERSIONED = (
    ("mpl-1.1", f"mpl {_V}1 1"), ("mpl-2.0", f"mpl {_V}2(?: 0)?"), ("lgpl-2.0", f"lgpl {_V}2(?: 0)?"), ("lgpl-3.0", f"lgpl {_V}3(?: 0)?"), ("agpl-3.0", f"agpl {_V}3(?: 0)?"),
    ("epl-1.0", f"epl {_V}1 0"), ("epl-2.0", f"epl {_V}2 0"),
)
_GRANT = "(?:licen[sc]ed|released|distributed|redistributed|published|available|provided|covered|governed|shared)"
GRANT_WORDS = "licensed licenced released distributed redistributed published available provided covered governed shared".split()
# Forms of mention, in order: name, anchor (None: the name's first word), text before the name, confidence.
FORMS = (
    ("tag", "spdx", "spdx licen[sc]e identifier ", 1.0),
    ("grant", "<grant>", _GRANT + " (?:under|by|subject to|as) (?:the )?(?:terms of )?(?:the )?(?:gnu )?(?=GNU)", 0.9),
    ("name", None, "", 0.6),
)
# Signatures that are not the mention of a license name.
OTHERS = (
    ("reserved", "all", "all rights reserved", 0.5), ("copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9]{2}", 0.4),
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy", 0.9),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose", 0.9),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted", 0.9),
    ("unlicense", "this", "this is free and unencumbered software released into the public domain", 0.9),
)


@dataclass(frozen=True)
class LicenseRule:
    order: int
    label: str
    anchor: str
    pattern: str
    score: float


def _longer_first(names) -> list[tuple[str, str]]:
    return sorted(names, key=lambda x: " " not in x[1])


def build_rules() -> tuple[LicenseRule, ...]:
    """All rules: forms by names, then the other signatures; order is priority."""
    rules = []
    for form, anchor, before, score in FORMS:
        # within a form the longer of two mentions must come first
        more = {"tag": [(label, x + (_GNU_SUFFIX if "gpl" in x or "gfdl" in x else "")) for label, x in SPDX_IDS], "grant": _longer_first(SHORT_NAMES), "name": list(VERSIONED)}[form]
        for label, name in [*NAMES, *more]:
            if form == "grant":
                # "under the GNU ..." may have lost nothing: a name that begins with gnu keeps it
                own = before.replace("(?:gnu )?(?=GNU)", "" if name.startswith("gnu ") else "(?:gnu )?")
            else:
                own = before
            rules.append((label, anchor or name.split(" ")[0].split("(")[0], own + name, score))
    rules += [(label, anchor, pattern, score) for label, anchor, pattern, score in OTHERS]
    return tuple(LicenseRule(k, label, anchor.replace("licen[sc]e", "license"), pattern, score) for k, (label, anchor, pattern, score) in enumerate(rules))


RULES = build_rules()
_SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def gate_word(pattern: str) -> str:
    """A word, or part of one, that every match of the pattern has."""
    rest = None
    while rest != pattern:
        rest, pattern = pattern, re.sub(r"\(\?[:=][^()]*\)\??", "", pattern)
    if "licen[sc]e" in rest:
        return "licen"
    return max(re.findall(r"(?<![\w\]])[a-z0-9]*[a-z][a-z0-9]*(?![\w\[])", rest), key=len)


def gate_of(rules) -> Callable[[Column], Column]:
    """Test on the lower-cased text that every text with a detection passes:
    long words anywhere, those of up to four characters as words."""
    needed = sorted({gate_word(r.pattern) for r in rules} | {gate_word(phrase) for phrase in BASE_PHRASES} | {"licen"})
    short = f"(?:^|{_SEPARATOR})(?:" + "|".join(w for w in needed if len(w) <= 4) + f")(?:{_SEPARATOR}|$)"

    def passes(low: Column) -> Column:
        gate = low.rlike(short)
        for word in needed:
            if len(word) > 4:
                gate = gate | F.contains(low, F.lit(word))
        return gate

    return passes


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), _SEPARATOR), "")


def _places(phrase: str) -> Column:
    """Places in ``__words`` where the words of ``phrase`` stand consecutively."""
    parts = phrase.split(" ")

    def here(word: Column, i: Column) -> Column:
        same = word == parts[0]
        for k, part in enumerate(parts[1:], 1):
            same = same & (F.get(F.col("__words"), i + k) == part)
        return F.when(same, i)

    return F.filter(F.transform("__words", here), lambda i: i.isNotNull())


def _labelled(places: Column, label: str) -> Column:
    return F.transform(places, lambda i: F.struct(i.alias("start"), F.lit(label).alias("label")))


def _detections(rules) -> Column:
    table = F.array(*(F.struct(F.lit(r.order).alias("order"), F.lit(r.label).alias("label"), F.lit(r.anchor).alias("anchor"), F.lit(f"^(?:{r.pattern})(?= |$)").alias("pattern"), F.lit(r.score).alias("score")) for r in rules))
    anchors = sorted({r.anchor for r in rules} | set(GRANT_WORDS))
    keyed = F.filter(F.transform("__words", lambda w, i: F.when(w.isin(*anchors), F.struct(i.alias("at"), F.when(w.isin(*GRANT_WORDS), F.lit("<grant>")).otherwise(w).alias("key")))), lambda a: a.isNotNull())

    def tried(a: Column) -> Column:
        """The best detection that starts at this anchor, or null."""
        reach = F.array_join(F.slice("__words", a["at"] + 1, REACH), " ")
        found = F.transform(
            F.filter(table, lambda r: r["anchor"] == a["key"]),
            lambda r: F.struct(r["order"].alias("order"), F.regexp_substr(reach, r["pattern"]).alias("hit"), r["label"].alias("label"), r["score"].alias("score")),
        )
        best = F.get(F.sort_array(F.filter(found, lambda x: x["hit"].isNotNull())), F.lit(0))
        size = F.size(F.split(best["hit"], " "))
        return F.when(best.isNotNull(), F.struct(a["at"].alias("start"), (a["at"] + size).alias("end"), best["order"].alias("order"), best["label"].alias("label"), best["score"].alias("score")))

    return F.filter(F.transform(keyed, tried), lambda d: d.isNotNull())


def _unsuppressed(found: Column) -> Column:
    """Detections that no earlier-ordered one contains or is contained in. There
    is one per start and none spans over ``REACH`` words, so only the nearest
    ``REACH`` neighbours on either side can be nested with it."""

    def beaten(d: Column, e: Column) -> Column:
        nested = ((e["start"] <= d["start"]) & (e["end"] >= d["end"])) | ((d["start"] <= e["start"]) & (d["end"] >= e["end"]))
        size = lambda x: x["end"] - x["start"]
        better = (e["score"] > d["score"]) | ((e["score"] == d["score"]) & ((size(e) > size(d)) | ((size(e) == size(d)) & (e["order"] < d["order"]))))
        return (e["start"] != d["start"]) & nested & better

    near = lambda i: F.slice(found, F.greatest(i + 1 - REACH, F.lit(1)), 2 * REACH)
    return F.filter(found, lambda d, i: ~F.exists(near(i), lambda e: beaten(d, e)))


def scan_licenses(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``n_words``, the places of the base phrases
    (``base``: start and label), ``detections`` (start, end, order, label, score)
    after suppression, ``base_labels``, ``labels`` and ``score``."""
    new = ("n_words", "base", "detections", "base_labels", "labels", "score")
    names = [c for c in docs.columns if c != text and c.lower() not in new]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    gate = gate_of(rules)(F.lower(body))
    n_words = F.regexp_count(body, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long")
    rows = docs.select(*(F.col(f"`{c}`") for c in names), n_words.alias("n_words"), F.when(gate, words_of(body)).otherwise(F.array().cast("array<string>")).alias("__words"))
    base = None
    for phrase, label in BASE_PHRASES.items():
        part = _labelled(_places(phrase), label)
        base = part if base is None else F.concat(base, part)
    rows = rows.withColumns({"base": base, "__found": _detections(rules)}).drop("__words")
    rows = rows.withColumn("detections", _unsuppressed(F.col("__found"))).drop("__found")
    distinct = lambda a: F.sort_array(F.array_distinct(a))
    base_labels = F.transform("base", lambda x: x["label"])
    labels = F.concat(base_labels, F.transform("detections", lambda x: x["label"]))
    best = F.array_max(F.transform("detections", lambda x: x["score"]))
    score = F.when(F.size("detections") > 0, best).when(F.size("base") > 0, F.lit(0.5)).otherwise(F.lit(0.0))
    return rows.withColumns({"base_labels": distinct(base_labels), "labels": distinct(labels), "score": score})


def digest(scanned: DataFrame) -> DataFrame:
    starts = F.transform("base", lambda x: x["start"])
    return scanned.withColumns({
        "n_base": F.size("base").cast("long"), "first_word": F.array_min(starts).cast("long"), "last_word": F.array_max(starts).cast("long"),
        "base_labels": F.array_join("base_labels", ","), "labels": F.array_join("labels", ","),
    })
