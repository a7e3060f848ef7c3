"""Changes to stored tables: conditional upsert, delete, schema evolution, rewriting, dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from errata.functions.lexicon import NORWEGIAN, PLACEHOLDER, Lexicon
from errata.functions.text import is_better, needs_refetch, trim_to_correction

MAX_RETRIES = 5


def to_refetch(raw: DataFrame, lexicon: Lexicon = NORWEGIAN) -> DataFrame:
    return raw.filter(needs_refetch(F.coalesce("correction_text_raw", "correction"), lexicon))


def upserted(table: DataFrame, new: DataFrame, column: str, *, key: str = "url", order: str | None = None, lexicon: Lexicon = NORWEGIAN) -> DataFrame:
    """The table with `column` replaced where new (key, new_text) is better. Of several new rows of a
    key the last by `order` counts (of those as late, the greatest text); without an order, the
    greatest text. The result does not depend on how the rows lie."""
    last = F.max(F.struct(order, "new_text"))["new_text"] if order else F.max("new_text")
    once = new.groupBy(F.col(key).alias("errata_key")).agg(last.alias("errata_new"))
    joined = table.join(once, F.col(key) == F.col("errata_key"), "left")
    better = F.coalesce(is_better(F.col("errata_new"), F.col(column), lexicon), F.lit(False))
    return joined.withColumn(column, F.when(better, F.col("errata_new")).otherwise(F.col(column))).select(*table.columns)


def deleted_where(table: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true; where it is unknown they stay."""
    return table.filter(~F.coalesce(condition, F.lit(False)))


def without_placeholders(raw: DataFrame, text: str = PLACEHOLDER, column: str = "correction_text_raw") -> DataFrame:
    return deleted_where(raw, F.contains(F.col(column), F.lit(text)))


def evolved(table: DataFrame, columns: dict[str, tuple[str, object]]) -> DataFrame:
    """The table with the columns (type, default) it lacks; those it has keep their values, nulls too."""
    return table.withColumns({c: F.lit(d).cast(k) for c, (k, d) in columns.items() if c not in table.columns})


def trimmed(table: DataFrame, columns: tuple[str, ...] = ("correction_text_raw", "correction"), lexicon: Lexicon = NORWEGIAN) -> DataFrame:
    return table.withColumns({c: trim_to_correction(F.col(c), lexicon) for c in columns})


def changes(before: DataFrame, after: DataFrame, column: str, key: str) -> DataFrame:
    """total and changed: how many values of the column differ."""
    joined = before.select(key, F.col(column).alias("old")).join(after.select(key, F.col(column).alias("new")), key)
    return joined.agg(F.count("*").alias("total"), F.count_if(~F.col("old").eqNullSafe(F.col("new"))).alias("changed"))


def to_retry(letters: DataFrame, known: DataFrame) -> DataFrame:
    """Dead letters that may be tried again: not yet collected, and tried less than five times."""
    tried = letters.filter(F.coalesce("retry_count", F.lit(0)) < MAX_RETRIES)
    return tried.join(known.select("url").distinct(), "url", "left_anti")


def after_retry(letters: DataFrame, known: DataFrame, failed: DataFrame, stamp: str) -> DataFrame:
    """Dead letters after a retry: those not tried stay, those that failed again (url, error) are
    counted up, the rest are resolved and gone. `exhausted` says that no retry is left."""
    again = failed.groupBy("url").agg(F.min("error").alias("errata_error"))
    marked = letters.join(known.select("url").distinct().withColumn("errata_known", F.lit(True)), "url", "left").join(again, "url", "left")
    count = F.coalesce("retry_count", F.lit(0))
    tried = F.col("errata_known").isNull() & (count < MAX_RETRIES)
    kept = marked.filter(~tried | F.col("errata_error").isNotNull())
    new = {
        "retry_count": F.when(tried, count + 1).otherwise(count),
        "last_error": F.when(tried, F.col("errata_error")).otherwise(F.col("last_error")),
        "last_retry": F.when(tried, F.lit(stamp)).otherwise(F.col("last_retry")),
    }
    out = kept.withColumns(new).select(*letters.columns)
    return out.withColumn("exhausted", F.col("retry_count") >= MAX_RETRIES)
