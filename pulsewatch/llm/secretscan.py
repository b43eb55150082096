"""Secret scans over an incremental blob ledger, in DataFrame operations only.

Every version of every path is content-addressed (SHA-256 of its text). The
ledger holds, per blob, which rule versions have scanned it and what they
found, so a run scans only blob and rule-version pairs it has not seen, once
per blob however many paths and versions hold it, and joins the findings
back to all of them.

Positions come from built-in functions: ``split`` and ``regexp_extract_all``
of one pattern give the gaps and the matches of the same left-to-right search, and running
sums of their lengths give code-point offsets.

Cases: null text is the empty blob, which has no findings. Null or repeated paths are
ordinary rows: each gets its blob's findings. Rules with another version are
scanned again; findings of rule versions not asked for are left out. An empty ledger or table
works.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import text_or_empty


@dataclass(frozen=True)
class Rule:
    """A pattern whose ``group`` must have ``least`` code points; failing matches are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        """Changes with the version or any part of the definition."""
        text = f"{self.pattern}|{self.group}|{self.least}"
        return f"{self.kind}@{self.version}#{hashlib.sha256(text.encode()).hexdigest()[:12]}"


# The base patterns, in the order in which kinds are listed.
BASE_RULES = (
    Rule("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    # Runs shorter than the least fail anyway; asking for it in the pattern finds the same spans sooner.
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
# Well-known credential shapes the base patterns miss. No pattern repeats a group, which the
# JVM matches by recursion, and none can start again inside a run it has already read:
# every pattern takes time linear in the text.
KNOWN_RULE = Rule("known", r"-----BEGIN [A-Z ]*PRIVATE KEY-----|gh[pousr]_[A-Za-z0-9]{36,}"
                           r"|xox[abprs]-[A-Za-z0-9-]{10,}", version=2)
# A signed web token. A first part alone also matches, so that its run is passed over whole, and is dropped.
TOKEN_RULE = Rule("webtoken", r"eyJ[A-Za-z0-9_-]{10,}(\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+)?", 1, 1)
RULES = (*BASE_RULES, KNOWN_RULE, TOKEN_RULE)

FINDINGS = ArrayType(StructType([
    StructField("start", LongType()), StructField("rank", LongType()), StructField("end", LongType()),
    StructField("rule", StringType())]))
LEDGER = StructType([StructField("blob", StringType()), StructField("rules", ArrayType(StringType())),
                     StructField("findings", FINDINGS)])


class Ledger:
    """The scan history in a shared folder; runs only ever append to it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        spark.createDataFrame([], LEDGER).write.mode("append").parquet(self.path)  # readable when empty

    def entries(self) -> DataFrame:
        return self.spark.read.schema(LEDGER).parquet(self.path)

    # -- scan -----------------------------------------------------------------
    def update(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES, path: str = "path",
               text: str = "text") -> None:
        """Scan the blobs of ``versions`` under the rules that have not seen them."""
        keys = F.array(*[F.lit(r.key) for r in rules])
        rows = versions.select(F.col(path).alias("path"), text_or_empty(text).alias("text")).filter("text <> ''")
        rows = rows.withColumn("blob", F.sha2("text", 256))
        seen = (self.entries().select("blob", F.explode("rules").alias("rule")).groupBy("blob")
                .agg(F.collect_set("rule").alias("seen")))
        one = rows.select("blob", "path").groupBy("blob").agg(F.min("path").alias("one"))
        todo = (one.join(seen, "blob", "left")
                .withColumn("todo", F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>"))))
                .filter(F.size("todo") > 0).select(F.col("blob").alias("b"), "one", "todo"))
        # One copy of each unseen blob: the narrow side is hashed and the texts stream past it.
        unseen = rows.join(todo.hint("shuffle_hash"),
                           (F.col("blob") == F.col("b")) & F.col("path").eqNullSafe(F.col("one")))
        hits = F.concat(*[F.when(F.array_contains("todo", r.key), _lengths(r, i))
                          .otherwise(F.array().cast(_LENGTHS)) for i, r in enumerate(rules)])
        scanned = unseen.select("blob", "todo", hits.alias("hits"))
        before = Window.partitionBy("blob", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
        placed = (scanned.select("blob", F.explode_outer("hits").alias("h"), "todo")
                  .select("blob", "todo", "h.*").distinct()
                  .withColumn("start", F.coalesce(F.sum(F.col("gap") + F.col("size")).over(before), F.lit(0)) + F.col("gap")))
        least = F.element_at(F.array(*[F.lit(r.least) for r in rules]), (F.col("rank") + 1).cast("int"))
        finding = F.when(F.col("part") >= least, F.struct(
            "start", "rank", (F.col("start") + F.col("size")).alias("end"),
            F.element_at(keys, (F.col("rank") + 1).cast("int")).alias("rule")))
        (placed.groupBy("blob").agg(F.first("todo").alias("rules"), F.array_sort(F.collect_list(finding)).alias("findings"))
         .select("blob", "rules", F.col("findings").cast(FINDINGS).alias("findings"))
         .write.mode("append").parquet(self.path))

    # -- read -----------------------------------------------------------------
    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(blob, spans): start, rank, kind, end of every finding of ``rules``, by start, then rule order."""
        listed = F.array(*[F.lit(r.key) for r in rules])
        kinds = F.array(*[F.lit(r.kind) for r in rules])
        rank = F.array_position(listed, F.col("f.rule"))
        return (self.entries().select("blob", F.explode("findings").alias("f")).filter(rank > 0)
                .select("blob", F.struct(F.col("f.start").alias("start"), rank.alias("rank"),
                                         F.element_at(kinds, rank.cast("int")).alias("kind"),
                                         F.col("f.end").alias("end")).alias("s"))
                .groupBy("blob").agg(F.array_sort(F.collect_set("s")).alias("spans")))


_LENGTHS = "array<struct<rank:bigint,i:int,gap:bigint,size:bigint,part:bigint>>"


def _lengths(rule: Rule, rank: int) -> Column:
    """Per match: its number and the lengths of the gap before it, of the match, and of the judged group."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    size = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    part = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    rows = F.transform(F.arrays_zip(size.alias("size"), part.alias("part"), F.slice(gaps, 1, F.size(size)).alias("gap")),
                       lambda x, i: F.struct(F.lit(rank).cast("long").alias("rank"), i.alias("i"),
                                             x["gap"].cast("long").alias("gap"), x["size"].cast("long").alias("size"),
                                             x["part"].cast("long").alias("part")))
    return F.when(F.regexp_like(text, pattern), rows).otherwise(F.array().cast(_LENGTHS))


def scan(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, path: str = "path",
         text: str = "text") -> DataFrame:
    """``path``, ``blob`` and ``spans`` of every version row, after bringing the ledger up to date."""
    ledger.update(versions, rules, path, text)
    rows = versions.select(F.col(path), F.sha2(text_or_empty(text), 256).alias("blob"))
    none = F.array().cast("array<struct<start:bigint,rank:bigint,kind:string,end:bigint>>")
    return rows.join(ledger.findings(rules), "blob", "left").withColumn("spans", F.coalesce("spans", none))


def equals(value: str):  # noqa: ANN201 - a predicate for higher-order functions
    return lambda x: x == F.lit(value)


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, path: str = "doc_id",
             text: str = "text", mask: str = "[secret]") -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``mask``; null texts stay null."""
    ledger.update(docs, rules, path, text)
    spans = ledger.findings(rules).select("blob", F.explode("spans").alias("s")).select("blob", "s.start", "s.end")
    # Overlapping spans become one: a span opens a stretch if it starts after all earlier ends.
    earlier = Window.partitionBy("blob").orderBy("start", "end")
    reach = F.max("end").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("opens", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int"))
    stretch = F.sum("opens").over(earlier.rowsBetween(Window.unboundedPreceding, 0))
    cuts = (opened.withColumn("stretch", stretch).groupBy("blob", "stretch")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"))
            .groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_cuts")))
    whole, found = F.col(text), F.col("_cuts")
    pieces = F.transform(F.sequence(F.lit(0), F.size(found)), lambda i: F.substring(
        whole,
        (F.when(i == 0, F.lit(0)).otherwise(F.get(found, i - 1)["end"]) + 1).cast("int"),
        (F.coalesce(F.get(found, i)["start"], F.length(whole)) - F.when(i == 0, F.lit(0)).otherwise(F.get(found, i - 1)["end"]))
        .cast("int")))
    clean = F.when(found.isNull(), whole).otherwise(F.array_join(pieces, mask))
    keyed = docs.withColumn("_blob", F.sha2(text_or_empty(text), 256))
    return (keyed.join(cuts.withColumnRenamed("blob", "_blob").hint("shuffle_hash"), "_blob", "left")
            .withColumn(text, clean).select(*docs.columns))
