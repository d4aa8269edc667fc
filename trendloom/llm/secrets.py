"""Secret scans over a history of files, with a ledger of contents that were scanned before.

Every version of every path is known by the SHA-256 of its content. The ledger, two tables in a
folder, holds which content was scanned by which version of which rule, and what was found; content
that stands at many paths or in many versions is scanned once, and a new version of one rule scans
with that rule only. Findings are joined back to all paths. All of it is built-in functions; texts
are shuffled once, after equal ones of a task have been put together.

Positions count code points. Matches of a rule are leftmost and don't overlap; those that are too
short are dropped afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trendloom.llm.common import picked, stored
from trendloom.session import new_folder


@dataclass(frozen=True)
class Rule:
    """A pattern, and how many characters ``group`` of a match has to have.

    A new pattern or length of a rule needs a new version. ``rank`` orders the findings of one start.
    """

    name: str
    rank: int
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


def either_case(text: str) -> str:
    """The pattern with each of its letters in upper or lower case."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in text)


# Fixed by the rules. The runs of access and hex that are too short can't hide a longer one, so their
# length stands in the pattern; what a short assignment takes is lost to a later one.
BASE = [
    Rule("assign", 0, f"({either_case('password|passwd|secret|token|api_?key')})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", 1, "AKIA[A-Z0-9]{14,}"),
    Rule("hex", 2, "[0-9a-f]{16,}"),
]
# Kinds of key that are known by their own look. Parts that a later part has to follow are bounded, so
# that no text takes time with the square of its length.
MORE = [
    Rule("pem", 3, "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("jwt", 4, "eyJ[A-Za-z0-9_-]{8,400}[.]eyJ[A-Za-z0-9_-]{8,1000}[.][A-Za-z0-9_-]{8,}"),
    Rule("forge", 5, "(ghp|gho|ghu|ghs|ghr|glpat)[_-][A-Za-z0-9_-]{20,}"),
]
RULES = [*BASE, *MORE]

# Unseen contents up to this number, of 32 bytes each, are made known to all tasks, so that texts that
# were scanned before aren't shuffled; beyond it all distinct texts are shuffled once.
FEW_UNSEEN = 100_000

SCANNED = "blob_id binary, rules array<string>"
FINDINGS = "blob_id binary, rule string, kind string, rank int, start long, end long"


class Ledger:
    """``scanned`` and ``findings`` below one folder; both are only ever appended to."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def _read(self, name: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    @property
    def scanned(self) -> DataFrame:
        return self._read("scanned", SCANNED)

    @property
    def findings(self) -> DataFrame:
        """Each finding once, also where a job that failed between the two tables was run again."""
        return self._read("findings", FINDINGS).distinct()

    def add(self, scanned: DataFrame, findings: DataFrame) -> None:
        """Findings first: a content counts as scanned only when all it holds is written."""
        findings.write.mode("append").parquet(f"{self.folder}/findings")
        scanned.write.mode("append").parquet(f"{self.folder}/scanned")


def addressed(versions: DataFrame, *keys: str, content: str = "text") -> DataFrame:
    """``blob_id`` and ``__text`` beside the keys; a null content is empty."""
    rows = picked(versions, *keys, content).toDF(*keys, "__text").withColumn("__text", F.coalesce(F.col("__text").cast("string"), F.lit("")))
    return rows.withColumn("blob_id", F.unhex(F.sha2("__text", 256)))


def unseen(blobs: DataFrame, ledger: Ledger, rules: list[Rule]) -> DataFrame:
    """``blob_id`` and ``todo``, the keys of the rules that have not scanned it, for contents with any."""
    done = ledger.scanned.select("blob_id", F.explode("rules").alias("rule")).groupBy("blob_id").agg(F.collect_set("rule").alias("done"))
    wanted = F.array(*[F.lit(r.key) for r in rules])
    rows = blobs.select("blob_id").distinct().join(done, "blob_id", "left")
    return rows.select("blob_id", F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>"))).alias("todo")).where(F.size("todo") > 0)


def matches(texts: DataFrame, rule: Rule) -> DataFrame:
    """A row per match that is long enough, of the contents in ``texts`` that the rule has to scan.

    The pieces between matches and the matches themselves take turns, so a running sum of their
    lengths gives every start. It runs over one content at a time, ordered, and holds no list.
    """
    pattern = F.lit(rule.pattern)
    hit = texts.where(F.array_contains("todo", rule.key) & F.col("__text").rlike(rule.pattern))
    pieces = F.split("__text", rule.pattern, -1)
    found = F.regexp_extract_all("__text", pattern, F.lit(0))
    kept = F.regexp_extract_all("__text", pattern, F.lit(rule.group))
    sizes = F.arrays_zip(F.transform(pieces, F.length).alias("gap"), F.transform(found, F.length).alias("size"), F.transform(kept, F.length).alias("kept"))
    rows = hit.select("blob_id", F.posexplode(sizes).alias("place", "m")).select("blob_id", "place", "m.*").where("size IS NOT NULL")
    upto = Window.partitionBy("blob_id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("size")).over(upto)).where(F.col("kept") >= rule.least)
    head = [F.lit(rule.key).alias("rule"), F.lit(rule.name).alias("kind"), F.lit(rule.rank).alias("rank")]
    return rows.select("blob_id", *head, (F.col("end") - F.col("size")).alias("start"), "end")


def scan(versions: DataFrame, ledger: Ledger, rules: list[Rule] = RULES, content: str = "text") -> DataFrame:
    """Scan what the ledger doesn't know, add it there, and return the new findings.

    Of contents that stand at many places one is scanned. Empty contents and empty tables are fine:
    they are scanned and hold nothing. Rerunning after a failure scans again what wasn't written.
    """
    spark = versions.sparkSession
    rows = addressed(versions, content=content)
    todo = stored(unseen(rows, ledger, rules), "unseen")
    if todo.count() <= FEW_UNSEEN:
        rows = rows.join(F.broadcast(todo.select("blob_id")), "blob_id", "left_semi")
    texts = rows.groupBy("blob_id").agg(F.first("__text").alias("__text")).join(todo, "blob_id")
    texts = texts.where(" OR ".join(f"(array_contains(todo, {_sql(r.key)}) AND __text RLIKE {_sql(r.pattern)})" for r in rules))
    texts = stored(texts, "suspects")
    found = matches(texts, rules[0])
    for rule in rules[1:]:
        found = found.unionByName(matches(texts, rule))
    found = stored(found, "found")
    ledger.add(todo.select("blob_id", F.col("todo").alias("rules")), found.select("blob_id", "rule", "kind", "rank", F.col("start").cast("long"), F.col("end").cast("long")))
    return found


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def per_blob(findings: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Per content: ``found``, its findings by start and then rank, of the given versions of rules."""
    own = findings.where(F.col("rule").isin([r.key for r in rules]))
    return own.groupBy("blob_id").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "end", "kind"))).alias("found"))


def at_paths(versions: DataFrame, ledger: Ledger, *keys: str, rules: list[Rule] = RULES, content: str = "text") -> DataFrame:
    """``keys``, ``blob_id`` and ``found`` for every row of ``versions``, repeated rows too.

    ``found`` is empty where nothing was found. Null keys are kept; other columns are not read.
    """
    rows = addressed(versions, *keys, content=content).drop("__text")
    rows = rows.join(per_blob(ledger.findings, rules), "blob_id", "left")
    nothing = F.array().cast(rows.schema["found"].dataType)
    return rows.select(*keys, "blob_id", F.coalesce("found", nothing).alias("found"))


def report(docs: DataFrame, ledger: Ledger, id: str = "doc_id") -> DataFrame:
    """Scan documents as the newest versions of their paths; per row counts, and spans as text."""
    scan(docs, ledger)
    rows = at_paths(docs, ledger, id)

    def spans(chosen: str) -> Column:
        return F.expr(f"array_join(transform(filter(found, f -> {chosen}), f -> concat_ws(':', f.kind, CAST(f.start AS STRING), CAST(f.end AS STRING))), ',')")

    def count(kind: str) -> Column:
        return F.expr(f"CAST(size(filter(found, f -> f.kind = '{kind}')) AS BIGINT)")

    return rows.select(
        id,
        *[count(r.name).alias(f"n_{r.name}") for r in BASE],
        F.sha2(spans(f"f.rank < {len(BASE)}"), 256).alias("base_sha256"),
        spans("true").alias("spans"),
    )


def fresh_ledger(spark: SparkSession) -> Ledger:
    """A ledger that is removed with the application."""
    return Ledger(spark, new_folder(spark, "ledger"))
