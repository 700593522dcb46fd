"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of a text is addressed by the SHA-256 of its bytes. The ledger (a
Parquet table) holds, per blob and rule version, what a scan found. A call scans
only pairs of blob and rule version that the ledger does not have yet, appends
them, and joins the findings back to all paths, so a text with thousands of
copies, or one that comes again next month, is scanned once. Raising a rule's
version scans that rule alone again.

Only DataFrame functions: a rule is a pattern with a cheap keyword test before
it, its matches and the text between them give the places as running sums.

Defined results: null counts as the empty text; texts without findings have
empty lists; places are code points, end exclusive; matches of one rule do not
overlap, those of different rules may; repeated rows give repeated results;
extra columns are kept, clashing ones replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SecretRule:
    """``keyword``: a pattern without which ``pattern`` cannot match. A match
    counts if its group ``group`` has ``least`` characters or more."""

    name: str
    pattern: str
    keyword: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


_KEYWORDS = r"(?i:(password|passwd|secret|token|api_?key))"

# The three base rules, in the order that breaks ties, then the method's.
BASE_RULES = (
    SecretRule("assign", _KEYWORDS + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _KEYWORDS + r"""["']?\x20*[:=]""", 2, 8),
    SecretRule("access", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]", 0, 16),
    SecretRule("hex", "[0-9a-f]{32,}", "[0-9a-f]{32}", 0, 32),
)
METHOD_RULES = (
    SecretRule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", "PRIVATE KEY-----"),
    SecretRule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}", r"gh[pousr]_"),
    SecretRule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", r"xox[abprs]-"),
    SecretRule("map_key", r"AIza[A-Za-z0-9_-]{35}", "AIza"),
    SecretRule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", "eyJ"),
    SecretRule("url_password", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:[^\s/:@]{3,64}@", "://"),
)
RULES = BASE_RULES + METHOD_RULES

# what the ledger holds per match, and what a scan returns (kind: the rule's number)
FOUND = "struct<start: int, end: int, rule: string>"
SPAN = "struct<start: int, kind: int, end: int, name: string>"
LEDGER_SCHEMA = f"blob string, rules array<string>, spans array<{FOUND}>"


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _ledger(spark, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException:  # no scan has been recorded yet
        return spark.createDataFrame([], LEDGER_SCHEMA)


def _matches(text: Column, rule: SecretRule, number: int) -> Column:
    """Array of (kind, lengths of the text before and of the match, counts)."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    rows = F.transform(
        F.arrays_zip(found.alias("found"), value.alias("value"), between.alias("between")),
        lambda x, i: F.struct(
            F.lit(number).alias("kind"), i.alias("i"), F.length(x["between"]).alias("before"), F.length(x["found"]).alias("size"), (F.length(x["value"]) >= rule.least).alias("counts")
        ),
    )
    return F.filter(rows, lambda x: x["size"].isNotNull())  # what follows the last match has no match of its own


def scan_blobs(blobs: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """Findings of ``blobs`` (``blob``, ``text``, ``pending``: keys of the rules
    to run): one row per blob that has any, with its ``spans``."""
    rows = None
    none = F.array().cast("array<struct<kind: int, i: int, before: int, size: int, counts: boolean>>")
    for number, rule in enumerate(rules):
        due = F.array_contains("pending", rule.key) & F.col("text").rlike(rule.keyword)
        part = F.when(due, _matches(F.col("text"), rule, number)).otherwise(none)
        rows = part if rows is None else F.concat(rows, part)
    placed = blobs.select("blob", F.explode(rows).alias("m")).select("blob", "m.*")
    order = Window.partitionBy("blob", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("before") + F.col("size")).over(order).cast("int")
    keys = F.element_at(F.array(*(F.lit(r.key) for r in rules)), F.col("kind") + 1)
    found = F.struct((F.col("end") - F.col("size")).alias("start"), F.col("end"), keys.alias("rule"))
    return placed.withColumn("end", end).where("counts").groupBy("blob").agg(F.collect_list(found).alias("spans"))


def _current(spans: Column, rules: tuple[SecretRule, ...]) -> Column:
    """The spans of the given rule versions, by start, then rule."""
    keys, names = F.array(*(F.lit(r.key) for r in rules)), F.array(*(F.lit(r.name) for r in rules))

    def span(x: Column) -> Column:
        kind = F.array_position(keys, x["rule"]).cast("int")
        return F.struct(x["start"].alias("start"), (kind - 1).alias("kind"), x["end"].alias("end"), F.element_at(names, kind).alias("name"))

    return F.sort_array(F.transform(F.filter(F.array_distinct(spans), lambda x: F.array_contains(keys, x["rule"])), span))


def scan_versions(versions: DataFrame, ledger_path: str, rules: tuple[SecretRule, ...] = RULES, text: str = "text") -> DataFrame:
    """``versions`` without the text, with ``blob`` and ``spans`` (all findings of
    the current rule versions, by start, then rule). New scans are appended to
    the ledger at ``ledger_path``, a folder that all executors share."""
    spark = versions.sparkSession
    names = [c for c in versions.columns if c != text and c.lower() not in ("blob", "spans")]
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    keys = F.array(*(F.lit(r.key) for r in rules))
    ledger = _ledger(spark, ledger_path)
    done = ledger.select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("done"))
    blobs = versions.select(blob_id(F.col(text)).alias("blob"), body).dropDuplicates(["blob"])
    pending = F.array_except(keys, F.coalesce(F.col("done"), F.array().cast("array<string>")))
    unseen = blobs.join(done, "blob", "left").select("blob", "text", pending.alias("pending")).where(F.size("pending") > 0)
    scanned = unseen.select("blob", F.col("pending").alias("rules"))
    # one row per scanned blob; those with findings come from the scan, the others only say that it was made
    found = scan_blobs(unseen, rules)
    new = scanned.withColumn("spans", F.lit(None).cast(f"array<{FOUND}>")).unionByName(found.select("blob", F.array().cast("array<string>").alias("rules"), "spans"))
    new.write.mode("append").parquet(ledger_path)
    current = (
        spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path).where(F.size("spans") > 0).groupBy("blob")
        .agg(_current(F.flatten(F.collect_list("spans")), rules).alias("spans"))
    )
    paths = versions.select(*(F.col(f"`{c}`") for c in names), blob_id(F.col(text)).alias("blob"))
    spans = F.coalesce(F.col("spans"), F.array().cast(f"array<{SPAN}>")).alias("spans")
    return paths.join(current, "blob", "left").select(*(F.col(f"`{c}`") for c in names), "blob", spans)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and digests of the spans of ``scan_versions``."""
    of = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_RULES))
    counts = {f"n_{rule.name}": of(k) for k, rule in enumerate(BASE_RULES)}
    return scanned.withColumns(counts | {"base_sha256": F.sha2(span_text(base).cast("binary"), 256), "spans": span_text(F.col("spans"))})
