"""Secret scans over an incremental ledger of blobs.

Every text, of every version of every path, is addressed by its SHA-256. The ledger holds, for each
blob, which rule versions have scanned it and the spans they found. A scan takes the pairs of blob
and rule version that the ledger lacks, reads one copy of each such blob, and joins the findings
back to all paths. Everything runs in Spark's own expressions.

Scale: rows that repeat path and text are reduced to one before their text is moved; the text is dealt
by blob and path together, so that a blob of very many paths does not meet in one task; the join back
is on rows without text, of which Spark splits a large blob. What is put together in a text with very
many matches grows with their number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from errata.llm.common import text_or_empty, written


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern`, leftmost and not overlapping, whose `group` has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}/{self.version}"


#: For runs of one class of characters the least length stands in the pattern, which finds the same.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
ADDED = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
RULES = BASE + ADDED
#: Spans that are put together at once.
BLOCK = 256
SPANS = "array<struct<start:int,kind:int,end:int>>"
LEDGER = f"blob binary, scanned map<string,{SPANS}>"


def spans_of(text: Column, rule: Rule, number: int) -> Column:
    """The rule's spans in code points. What lies between the matches gives their places."""
    pattern = F.lit(rule.pattern)
    between = F.split(text, rule.pattern, -1)
    parts = F.arrays_zip(
        F.transform(F.slice(between, 1, F.size(between) - 1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length).alias("size"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length).alias("own"),
    )

    def step(at: Column, part: Column) -> tuple[Column, Column, Column]:
        start = at + part["gap"]
        end = start + part["size"]
        return end, part["own"] >= rule.least, F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"))

    return F.when(text.rlike(rule.pattern), carried(parts, step, SPANS)).otherwise(F.array().cast(SPANS))


def carried(items: Column, step, kind: str) -> Column:
    """The values that step(number carried, item) = (number, whether to keep, value) keeps, of the
    array kind. Items are taken in blocks, so that the work grows with their number and not with its
    square, as it would if an array were copied for every item."""
    nothing = F.array().cast(kind)
    count = F.ceil(F.size(items) / BLOCK).cast("int")
    blocks = F.transform(F.filter(F.sequence(F.lit(0), count), lambda b: b < count), lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))

    def one(done: Column, item: Column) -> Column:
        at, keep, value = step(done["at"], item)
        return F.struct(at.alias("at"), F.when(keep, F.concat(done["out"], F.array(value))).otherwise(done["out"]).alias("out"))

    def block(done: Column, own: Column) -> Column:
        inner = F.aggregate(own, F.struct(done["at"].alias("at"), nothing.alias("out")), one)
        return F.get(F.transform(F.array(inner), lambda i: F.struct(i["at"].alias("at"), F.concat(done["out"], F.array(i["out"])).alias("out"))), F.lit(0))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
    return F.flatten(F.aggregate(blocks, start, block, lambda done: done["out"]))


def addressed(paths: DataFrame, key: str, text: str, version: str | None = None) -> DataFrame:
    """path, (version,) blob, spot (a number of the path) and text of every row."""
    more = [F.col(version).alias("version")] if version else []
    return paths.select(F.col(key).alias("path"), *more, F.unhex(F.sha2(text_or_empty(text), 256)).alias("blob"), F.xxhash64(F.col(key)).alias("spot"), text_or_empty(text).alias("text"))


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def load_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger that save_ledger() wrote last, or an empty one."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(target):
        return empty_ledger(spark)
    runs = sorted(s.getPath().getName() for s in files.listStatus(target) if files.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))
    return spark.read.schema(LEDGER).parquet(f"{path}/{runs[-1]}") if runs else empty_ledger(spark)


def save_ledger(ledger: DataFrame, path: str, run: str) -> None:
    """Keep the ledger of a run, named so that later runs sort behind it. A run that breaks off leaves
    no _SUCCESS and is not read."""
    ledger.write.parquet(f"{path}/{run}")


def update(paths: DataFrame, ledger: DataFrame | None = None, *, key: str = "doc_id", text: str = "text", version: str | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """(path, version if there is one, and blob of every row; the ledger after scanning what it lacked).

    Null text is the empty blob. Any number of rows may have the same path (its versions) or text;
    rows that repeat both are scanned once. Without rows the ledger stays as it was. A null path
    counts as a path.
    """
    spark = paths.sparkSession
    if ledger is None:
        ledger = empty_ledger(spark)
    ledger = written(ledger.select("blob", "scanned"), "ledger")
    all_texts = addressed(paths, key, text, version)
    known = written(all_texts.drop("text"), "paths")
    names = F.array(*[F.lit(r.name) for r in rules])
    todo = known.groupBy("blob").agg(F.min("spot").alias("spot"))
    if ledger.isEmpty():
        todo = todo.withColumn("lacking", names)
    else:
        seen = F.coalesce(F.map_keys("scanned"), F.array().cast("array<string>"))
        todo = todo.join(ledger, "blob", "left").select("blob", "spot", F.array_except(names, seen).alias("lacking")).filter("size(lacking) > 0")
    # One text of each blob and path, repeats being dropped before texts are moved. They come in the
    # order of the keys, so a merge with what is to be scanned sorts no text and holds none.
    texts = all_texts.groupBy("blob", "spot").agg(F.first("text").alias("text")).join(todo.hint("merge"), ["blob", "spot"])
    body = F.col("text")
    entries = [F.struct(F.lit(r.name).alias("key"), F.when(F.array_contains("lacking", r.name), spans_of(body, r, i)).alias("value")) for i, r in enumerate(rules)]
    scanned = texts.select("blob", F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull())).alias("scanned"))
    new = written(scanned.groupBy("blob").agg(F.first("scanned").alias("scanned")), "scanned")
    known = known.drop("spot")
    if ledger.isEmpty():
        return known, new
    old = ledger.withColumnRenamed("scanned", "before")
    empty = F.create_map().cast(f"map<string,{SPANS}>")
    both = old.join(new, "blob", "full").select("blob", F.map_concat(F.coalesce("before", empty), F.coalesce("scanned", empty)).alias("scanned"))
    return known, written(both, "ledger")


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob and its spans under these rule versions, by start, then rule; blobs without spans are left out."""
    nothing = F.array().cast(SPANS)
    spans = F.array_sort(F.concat(*[F.coalesce(F.try_element_at("scanned", F.lit(r.name)), nothing) for r in rules]))
    return ledger.select("blob", spans.alias("spans")).filter("size(spans) > 0")


def report(known: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per path row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_spans."""
    found = known.join(findings(ledger, rules), "blob", "left")
    spans = F.coalesce("spans", F.array().cast(SPANS))
    kinds = F.array(*[F.lit(r.kind) for r in rules])

    def shown(wanted: Column) -> Column:
        return F.array_join(F.transform(wanted, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")

    base = [r.kind for r in BASE]

    def of_kind(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: F.get(kinds, s["kind"]) == kind)).cast("long")

    counts = [of_kind(k).alias(f"n_{k}") for k in base]
    in_base = F.filter(spans, lambda s: F.get(kinds, s["kind"]).isin(base))
    return found.select(F.col("path").alias("doc_id"), *counts, F.sha2(shown(in_base), 256).alias("base_sha256"), shown(spans).alias("spans"), F.size(spans).cast("long").alias("n_spans"))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each span (overlapping ones together) replaced by the mark."""

    def step(at: Column, s: Column) -> tuple[Column, Column, Column]:
        return F.greatest(at, s["end"]), s["start"] >= at, F.substring(text, at + 1, s["start"] - at)

    end = F.array_max(F.transform(spans, lambda s: s["end"]))
    return F.array_join(F.concat(carried(spans, step, "array<string>"), F.array(F.substring(text, end + 1, F.length(text)))), mark)


def redact(documents: DataFrame, *, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Documents with their secrets replaced by a mark, and n_chars (if there is one) counted anew.

    All rows and columns stay; texts without secrets, null texts among them, pass unchanged.
    """
    _, ledger = update(documents, rules=rules)
    found = findings(ledger, rules).select(F.col("blob").alias("errata_blob"), F.col("spans").alias("errata_spans")).hint("shuffle_hash")
    own = F.unhex(F.sha2(text_or_empty(), 256))
    joined = documents.withColumn("errata_own", own).join(found, F.col("errata_own") == F.col("errata_blob"), "left")
    hit = F.col("errata_spans").isNotNull()
    out = joined.withColumn("text", F.when(hit, redacted(F.col("text"), F.col("errata_spans"))).otherwise(F.col("text")))
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(hit, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*documents.columns)


