"""Pieces that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint, shared_folder  # noqa: F401  (operators take both from here)

#: The white space that the word definition `[^\x20\x09-\x0D]+` leaves out.
SPACE = " \t\n\x0b\x0c\r"
_SPLIT = "[ \\t\\n\\x0B\\f\\r]+"


def let(value: Column, body) -> Column:
    """body(value), with value computed once a row however often body names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.filter(F.split(trimmed, _SPLIT), lambda w: w != "")


def n_words(text: Column) -> Column:
    """How many words a text has, as a long; 0 for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, _SPLIT))).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def broadcast_if_small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """df with a broadcast hint if its counted rows are within the limit, else df as it is."""
    return F.broadcast(df) if rows <= limit else df


def partitions(spark: SparkSession) -> int:
    """How many partitions shuffles of the session have."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: There are at most so many hot keys, whatever the table: a key is hot from this part of all rows on.
HOT_KEYS = 10_000


def join_named(rows: DataFrame, named: DataFrame, keys: list[str], total: int, least: int = 1000, left: bool = False, alone: Column | None = None) -> DataFrame:
    """rows joined with named on keys; rows of hot keys meet theirs by a broadcast.

    left: rows whose keys are not named stay, with nulls. alone: a condition for rows that are known
    to have none, so that they need not meet.

    named: one row a key, with its further columns and ``times``, the number of rows that have the
    key; no null keys. A key is hot if it has more than ``total / HOT_KEYS`` of the ``total`` rows,
    and ``least`` at least, so the broadcast has at most HOT_KEYS rows of it. Rows of all other keys
    are joined by a shuffle, in which hot rows take part under random keys and find nothing.
    """
    limit = max(least, total // HOT_KEYS)
    made = [c for c in named.columns if c not in (*keys, "times")]
    plain = named.drop("times")
    hot = named.where(F.col("times") > limit).drop("times")
    if hot.isEmpty() and alone is None:
        return rows.join(plain, keys, "left" if left else "inner").select(*[F.col(f"`{c}`") for c in (*rows.columns, *made)])
    hot = hot.withColumnsRenamed({c: f"__hot_{c}" for c in made}).withColumn("__hot", F.lit(True))
    aside = F.col("__hot") if alone is None else F.coalesce(F.col("__hot"), F.lit(False)) | alone
    tagged = rows.join(F.broadcast(hot), keys, "left").withColumn("__salt", F.when(aside, 1 + F.floor(F.rand(3) * 10_000).cast("int")).otherwise(0))
    cold = named.where(F.col("times") <= limit).drop("times").withColumn("__salt", F.lit(0)).withColumn("__cold", F.lit(True))
    joined = tagged.join(cold, [*keys, "__salt"], "left")
    joined = joined if left else joined.where("__hot OR __cold")
    kept = [F.col(f"`{c}`") for c in rows.columns]
    return joined.select(*kept, *[F.when(F.col("__hot"), F.col(f"__hot_{c}")).otherwise(F.col(c)).alias(c) for c in made])


def stratified(rows: DataFrame, label: str, name: str, most: int) -> DataFrame:
    """(label, name): for each label the ``most`` names with the smallest hashes, each once; all if there are fewer.

    Labels are few. Names are thinned out by their hashes before they are ranked, so the ranking
    sees about twice as many as it keeps, however many there are.
    """
    distinct = checkpoint(rows.select(F.col(label), F.col(name), F.xxhash64(F.col(name), F.lit("sample")).alias("__h")).distinct())
    share = distinct.groupBy(label).agg((F.lit(2.0 * most) / F.count(F.lit(1))).alias("__share"))
    spot = (F.col("__h") / F.lit(2.0**64)) + 0.5
    near = distinct.join(F.broadcast(share), label).where(spot < F.col("__share") + 64.0 / F.lit(most) * F.col("__share"))
    nth = F.row_number().over(Window.partitionBy(label).orderBy("__h", name))
    return near.withColumn("__nth", nth).where(F.col("__nth") <= most).select(label, name)


def others(df: DataFrame, *made: str) -> list[Column]:
    """The columns of df but those named like what is made, in any case; what is made takes their place."""
    taken = {m.lower() for m in made}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
