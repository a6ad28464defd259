"""Secret scans: an incremental ledger of content-addressed blobs.

Every version of every path is named by the SHA-256 of its content.  A ledger
(a Parquet table in the shared folder) has one row per blob and scan: the
rules, by name and version, that the scan applied, and what they found.  A scan
looks up which (blob, rule version) pairs the ledger does not hold, reads only
those blobs, each content once however many paths and versions hold it, with
only the rules it lacks, appends the findings, and joins the findings of the
current rule versions back to all paths.  A rule whose version changes is
scanned again; findings of its earlier versions stay in the ledger unused.

Base rules, leftmost and not overlapping within a kind: ``assign`` (a labelled
value of 12 characters or more), ``access`` (access key ids), ``hex`` (16 or
more hexadecimal digits).  Added rules: private key headers, repository, chat
and service tokens, signed web tokens.

Only DataFrame functions are used.  Offsets come from the lengths of the
pieces between matches, so they count code points.  A blob held by very many
paths is one row of the ledger; its join back to the paths can be split.

Defined results: a null text counts as empty and has no findings; paths with
nulls in any column keep their rows; repeated rows each keep a row; an empty
table gives an empty result and appends nothing; other columns are kept, names
beginning with ``__`` are reserved and raise; very long texts are scanned whole
by expressions that do not recurse.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scriptmill.llm.common import materialize, reserve
from scriptmill.session import ensure_checkpoint_dir

SPANS = "array<struct<kind:string,start:int,stop:int>>"
LEDGER = f"blob string, rules array<string>, spans {SPANS}"


@dataclass(frozen=True)
class Rule:
    """What a rule finds: matches of ``pattern`` that also hold ``keep`` (null: all)."""

    kind: str
    version: int
    pattern: str
    keep: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_LABELS = "|".join(map(_either_case, ("password", "passwd", "secret", "token"))) + "|" + _either_case("api") + "_?" + _either_case("key")
_BEFORE = rf"""(?:{_LABELS})["']?\x20*[:=]\x20*["']?"""
BASE = (
    # a short value is matched too, and dropped after: what it covers can begin no other match
    Rule("assign", 1, rf"{_BEFORE}[A-Za-z0-9+/_.=-]+", rf"^{_BEFORE}[A-Za-z0-9+/_.=-]{{12,}}$"),
    # a run too short can hold no longer one, so the bound stands in the pattern
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", 1, r"[0-9a-f]{16,}"),
)
ADDED = (
    Rule("private_key", 1, r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |PGP )?PRIVATE KEY(?: BLOCK)?-----"),
    Rule("repository_token", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", 1, r"xox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("service_key", 1, r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("web_token", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}"),
)
RULES = BASE + ADDED


def new_ledger(spark: SparkSession) -> str:
    """A place for a ledger in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-ledger-{uuid.uuid4().hex}"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows; none while nothing was written."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def address(content: Column) -> Column:
    """The name of a content: SHA-256 of its UTF-8 bytes (null: empty)."""
    return F.sha2(F.coalesce(content, F.lit("")).cast("binary"), 256)


def rule_pieces(text: Column, rule: Rule) -> Column:
    """The matches of one rule in a text, in order, as lengths: what lies before
    each and the match itself, and whether it is kept."""
    gaps, hits = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    real = F.filter(F.zip_with(gaps, hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit"))),
                    lambda p: p["hit"].isNotNull())  # the piece behind the last match has none
    keep = lambda hit: F.lit(True) if rule.keep is None else hit.rlike(rule.keep)
    return F.transform(real, lambda p, i: F.struct(
        F.lit(rule.kind).alias("kind"), i.alias("i"), F.length(p["gap"]).alias("gap"), F.length(p["hit"]).alias("size"),
        keep(p["hit"]).alias("keep")))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for ``blob, content, todo`` (the rule names to apply).

    Offsets are running sums over a blob's matches, a row each: linear however
    many a text holds."""
    none = F.expr("cast(array() as array<struct<kind:string,i:int,gap:int,size:int,keep:boolean>>)")
    text = F.col("content")
    found = [F.when(F.array_contains("todo", r.name) & text.rlike(r.pattern), rule_pieces(text, r)).otherwise(none) for r in rules]
    read = materialize(blobs.select("blob", F.col("todo").alias("rules"), F.concat(*found).alias("pieces")), "blob-matches")
    w = Window.partitionBy("blob", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = (read.filter(F.size("pieces") > 0).select("blob", F.explode("pieces").alias("p")).select("blob", "p.*")
             .withColumn("stop", F.sum(F.col("gap") + F.col("size")).over(w).cast("int")).filter("keep")
             .groupBy("blob").agg(F.collect_list(F.struct("kind", (F.col("stop") - F.col("size")).alias("start"), "stop")).alias("spans")))
    return (read.select("blob", "rules").join(spans.hint("merge"), "blob", "left")
            .select("blob", "rules", F.coalesce("spans", F.expr(f"cast(array() as {SPANS})")).alias("spans")))


def scan(versions: DataFrame, ledger: str, content: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row of ``versions`` without its content, plus ``__blob`` and
    ``__spans`` (kind, start, stop by start, then by the order of ``rules``);
    the ledger grows by what it did not hold."""
    spark = versions.sparkSession
    reserve(versions)
    named = versions.withColumn("__blob", address(F.col(content)))
    names = F.array(*[F.lit(r.name) for r in rules])
    addresses = materialize(named.drop(content), "addresses")
    seen = (read_ledger(spark, ledger).select("blob", F.explode("rules").alias("rule")).groupBy("blob")
            .agg(F.collect_set("rule").alias("seen")))
    held = F.coalesce("seen", F.expr("cast(array() as array<string>)"))
    todo = (addresses.select(F.col("__blob").alias("blob")).distinct().join(seen.hint("merge"), "blob", "left")
            .select("blob", F.array_except(names, held).alias("todo")).filter(F.size("todo") > 0))
    # one row per content: copies meet before the shuffle, a content held by a third of the rows is one row a task
    contents = (named.select(F.col("__blob").alias("blob"), F.coalesce(content, F.lit("")).alias("content")).dropDuplicates(["blob"]))
    scan_blobs(contents.join(todo.hint("merge"), "blob"), rules).write.mode("append").option("compression", "zstd").parquet(ledger)
    kinds = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    current = (read_ledger(spark, ledger).filter(F.size("spans") > 0)
               # findings of rules that the scan applied in their current version
               .select("blob", F.filter("spans", lambda s: F.exists("rules", lambda r: F.array_contains(names, r) & (
                   F.substring_index(r, "@", 1) == s["kind"]))).alias("spans")))
    ordered = F.transform(
        F.array_sort(F.transform(F.array_distinct(F.flatten(F.collect_list("spans"))), lambda s: F.struct(
            s["start"].alias("start"), F.element_at(kinds, s["kind"]).alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind")))),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    findings = current.groupBy("blob").agg(ordered.alias("__spans")).withColumnRenamed("blob", "__found")
    return (addresses.join(findings.hint("merge"), F.col("__blob") == F.col("__found"), "left").drop("__found")
            .withColumn("__spans", F.coalesce("__spans", F.expr(f"cast(array() as {SPANS})"))))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def digest(scanned: DataFrame) -> DataFrame:
    """``doc_id``, the base counts, the digest of the base spans, all spans."""
    base = F.filter("__spans", lambda s: s["kind"].isin(*[r.kind for r in BASE]))
    count = lambda kind: F.size(F.filter("__spans", lambda s: s["kind"] == kind)).cast("long")
    return scanned.select("doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in BASE],
                          F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("__spans")).alias("spans"))
