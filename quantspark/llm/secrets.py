"""Secret scans over an incremental blob ledger, in DataFrame operations only.

Every version of every path is content-addressed (SHA-256 of its text). The
ledger is a Parquet folder with one row per scanned blob and increment: blob,
the rule versions that were run on it, and the spans they found. Rows that stand
twice in it, as after two scans at the same time, count once. A scan

1. keeps one row per distinct blob (copies are folded before the shuffle),
2. runs, on each blob, the rules whose versions the ledger lacks for it,
3. appends the outcome to the ledger, and
4. joins the ledger's findings back to every path that holds the blob.

Span positions: a rule's pattern splits a text into the pieces between its
matches; a match starts where the pieces and matches before it end. The running
sum is a window over the matches of one text and rule. Positions are code
points, end exclusive. Matches are leftmost and non-overlapping per rule, and
those whose measured part is shorter than ``least`` are dropped afterwards.

Defined cases: a null text is an empty one; paths may be null or repeated, each
row gets its blob's findings; no rows give no rows and an empty increment;
extra columns are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantspark.llm.common import fresh, read, shared_path, stage

LEDGER_SCHEMA = "blob string, versions array<string>, spans array<struct<version:string, start:long, end:long>>"
MASK = "[SECRET]"


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0  # the group that ``least`` measures
    least: int = 1
    revision: int = 1
    runs: str | None = None  # class whose runs ``pattern`` matches whole

    @property
    def scanned(self) -> str:
        """Where a class is too common to be split at every match, the same spans
        come from its long runs: a run shorter than ``least`` is dropped either way."""
        return f"{self.runs}{{{self.least},}}" if self.runs else self.pattern

    @property
    def version(self) -> str:
        """Of what the rule finds: a changed pattern is a new version under any revision."""
        seen = hashlib.sha256(f"{self.group}:{self.least}:{self.scanned}".encode()).hexdigest()[:12]
        return f"{self.kind}@{self.revision}-{seen}"


# The first three are the base rules; the rest are formats that
# issuers publish for their credentials.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24, runs="[0-9a-f]"),
    # to the END line; without one, header lines and base64
    Rule("pem", r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?)-----"
                r"(?:[^-]*+(?:-(?!----)[^-]*+)*+-----END \1-----|(?:\s++[A-Za-z][A-Za-z0-9-]*+:[^\r\n]*+){0,16}+[A-Za-z0-9+/=\s]*)", revision=2),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("bearer", r"Bearer [A-Za-z0-9._~+/-]{20,}=*"),
)
BASE = ("assign", "access", "hex")


def blob_of(text: str | Column) -> Column:
    return F.sha2(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), 256)


def _hits(rule: Rule) -> Column:
    """Per match: its number, the lengths of the piece before it, of itself and of its measured part."""
    pattern = F.lit(rule.scanned)
    whole = F.regexp_extract_all("text", pattern, F.lit(0))
    part = F.regexp_extract_all("text", pattern, F.lit(rule.group)) if rule.group else whole
    before = F.split("text", pattern, -1)
    each = F.transform(F.arrays_zip(before.alias("b"), whole.alias("w"), part.alias("p")),
                       lambda x, i: F.struct(F.lit(rule.version).alias("version"), i.alias("i"),
                                             F.length(x["b"]).alias("gap"), F.length(x["w"]).alias("len"),
                                             (F.length(x["p"]) >= rule.least).alias("ok")))
    return F.filter(each, lambda x: x["len"].isNotNull())


def _scan_blobs(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Ledger rows from (blob, text, seen): rules whose version is not in ``seen``."""
    none = F.array().cast("array<struct<version:string,i:int,gap:int,len:int,ok:boolean>>")
    todo = {r: ~F.array_contains("seen", r.version) for r in rules}
    hits = [F.when(todo[r] & F.col("text").rlike(r.scanned), _hits(r)).otherwise(none) for r in rules]
    done = F.array_compact(F.array(*[F.when(todo[r], F.lit(r.version)) for r in rules]))
    raw = stage(texts.select("blob", done.alias("versions"), F.concat(*hits).alias("hits")).filter(F.size("versions") > 0), "hits")
    so_far = Window.partitionBy("blob", "version").orderBy("i")
    spans = (raw.select("blob", F.inline("hits"))
             .withColumn("end", F.sum(F.col("gap").cast("long") + F.col("len")).over(so_far)).filter("ok")
             .groupBy("blob").agg(F.array_sort(F.collect_list(
                 F.struct("version", (F.col("end") - F.col("len")).alias("start"), "end"))).alias("spans")))
    empty = F.array().cast("array<struct<version:string,start:long,end:long>>")
    return raw.select("blob", "versions").join(spans, "blob", "left").select("blob", "versions", F.coalesce("spans", empty).alias("spans"))


def _exists(spark: SparkSession, path: str) -> bool:
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def update_ledger(docs: DataFrame, ledger: str, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Scan what the ledger lacks, append it, and return (blob, spans) with the
    spans (kind, start, end, rank) that the current rule versions have in the
    ledger, for blobs with any."""
    spark = docs.sparkSession
    texts = docs.select(blob_of(text).alias("blob"), F.coalesce(text, F.lit("")).alias("text")).dropDuplicates(["blob"])
    if _exists(spark, ledger):
        seen = (spark.read.schema(LEDGER_SCHEMA).parquet(ledger).groupBy("blob")
                .agg(F.flatten(F.collect_list("versions")).alias("seen")))
        texts = texts.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
    else:
        texts = texts.withColumn("seen", F.array().cast("array<string>"))
    _scan_blobs(texts, rules).write.mode("append").parquet(ledger)
    book = spark.read.schema(LEDGER_SCHEMA).parquet(ledger)
    kinds = F.create_map(*[F.lit(x) for r in rules for x in (r.version, r.kind)])
    ranks = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.version), F.lit(i))])
    live = F.filter("spans", lambda s: s["version"].isin([r.version for r in rules]))
    named = F.transform(live, lambda s: F.struct(s["start"].alias("start"), ranks[s["version"]].alias("rank"),
                                                 s["end"].alias("end"), kinds[s["version"]].alias("kind")))
    return (book.select("blob", named.alias("spans")).filter(F.size("spans") > 0)
            .groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans")))


def scan(docs: DataFrame, ledger: str | None = None, path: str = "doc_id", text: str = "text",
         rules: Sequence[Rule] = RULES) -> DataFrame:
    """(path, blob, spans): one row per row of ``docs``; spans sorted by start,
    then by the rules' order. Without ``ledger`` a new one is begun in the
    shared folder."""
    ledger = ledger or shared_path(docs.sparkSession, "secret-ledger")
    found = update_ledger(docs, ledger, text, rules)
    paths = docs.select(F.col(path).alias(path), blob_of(text).alias("blob"))
    none = F.array().cast("array<struct<start:long,rank:int,end:long,kind:string>>")
    return paths.join(found, "blob", "left").select(path, "blob", F.coalesce("spans", none).alias("spans"))


def redact(docs: DataFrame, ledger: str | None = None, text: str = "text", mask: str = MASK,
           rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with every found span (overlapping ones as one) replaced by
    ``mask``. An ``n_chars`` column is kept in step."""
    ledger = ledger or shared_path(docs.sparkSession, "secret-ledger")
    found = update_ledger(docs, ledger, text, rules)
    order = Window.partitionBy("blob").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    cuts = (found.select("blob", F.inline("spans")).withColumn("new", (F.coalesce(reach, F.lit(-1)) < F.col("start")).cast("int"))
            .withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("blob", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
            .groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts")))
    blob, cut = fresh(docs, "blob"), fresh(docs, "cuts")
    joined = docs.withColumn(blob, blob_of(text)).join(cuts.select(F.col("blob").alias(blob), F.col("cuts").alias(cut)), blob, "left")
    at = F.col(cut)
    piece = F.transform(at, lambda x, i: F.substring(
        F.col(text), F.when(i == 0, F.lit(0)).otherwise(F.get(at, i - 1)["end"]).cast("int") + 1,
        (x["start"] - F.when(i == 0, F.lit(0)).otherwise(F.get(at, i - 1)["end"])).cast("int")))
    tail = F.substring(F.col(text), F.element_at(at, -1)["end"].cast("int") + 1, F.lit(2**31 - 1))
    clean = F.when(at.isNull(), F.col(text)).otherwise(F.concat(F.array_join(F.transform(piece, lambda p: F.concat(p, F.lit(mask))), ""), tail))
    out = joined.withColumn(text, clean)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(at.isNull(), F.col("n_chars")).otherwise(F.length(text).cast(kind)))
    return out.select(*docs.columns)


def digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(read(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return out.select("doc_id", *[count(k) for k in BASE], F.sha2(digest(base), 256).alias("base_sha256"),
                      digest(F.col("spans")).alias("spans"))
