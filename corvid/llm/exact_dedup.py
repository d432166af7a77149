"""Exact dedup: skew-safe combining on full content (built-in functions only).

1. *Local*: each input partition groups its own rows by (digest, content); Spark's
   partial aggregate does this before anything is shuffled, so a text with many
   copies leaves a partition as one row.
2. *Salted merge*: local winners meet per (digest, salt, content).  The salt comes
   from the input partition, so the copies of one hot text are merged by up to
   ``salts`` tasks.
3. *Global*: the salt winners (at most ``salts`` per text) are combined per
   (digest, content).

Every stage groups on the whole normalised content; the digest only routes.
The documents then look their group up by digest, which needs no text: stage 3
has counted how many different contents a digest stands for, and digests
with more than one (a collision) are looked up by (digest, content) instead.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import stored, text_of, without_blanks

_WIDTH = 10 ** 20  # decimal places that hold 2^63 - id
_TOP = 2 ** 63


def sha256_of(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def _rank(length: Column, doc_id: Column) -> Column:
    """One number that is larger for a longer text, then for a smaller id (null id last).

    A decimal keeps the aggregate buffer fixed-size, so Spark can hash-aggregate.
    """
    place = F.coalesce(F.lit(Decimal(_TOP)) - doc_id.cast("decimal(20,0)"), F.lit(Decimal(0)))
    return (length.cast("decimal(10,0)") * F.lit(Decimal(_WIDTH)) + place).cast("decimal(38,0)")


def _id_of(rank: Column) -> Column:
    place = rank % F.lit(Decimal(_WIDTH))
    return F.when(place != 0, (F.lit(Decimal(_TOP)) - place).cast("long"))


def _combine(rows: DataFrame, salts: int) -> DataFrame:
    """Stages 1 to 3: one row per (digest, content) with its size and best rank."""
    salted = (rows.withColumn("_salt", F.spark_partition_id() % F.lit(salts))
              .groupBy("_digest", "_salt", "_norm")
              .agg(F.count(F.lit(1)).alias("_n"), F.max("_rank").alias("_best")))
    return salted.groupBy("_digest", "_norm").agg(F.sum("_n").alias("_n"), F.max("_best").alias("_best"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     salts: int = 32, digest: Callable[[Column], Column] = sha256_of) -> DataFrame:
    """Group documents whose texts are equal after deleting white space ``[\\x20\\x09-\\x0D]``.

    Returns one row per input row: ``doc_id, keep_id, group_size, kept, digest`` (binary).
    Of equal texts the one with the most code points stays, then the smallest id.
    Null text counts as empty; empty texts are equal to each other.  A null id
    ranks after every other id; rows that tie with the winner in id and length
    (repeated rows) cannot be told apart and are all ``kept``.  An empty table gives
    an empty result; other columns of ``docs`` are not read.
    """
    text = text_of(text_col)
    base = docs.select(F.col(id_col).cast("long").alias("_id"), text.alias("_text"))
    rows = (base.select("_id", F.length("_text").alias("_len"), without_blanks(F.col("_text")).alias("_norm"))
            .select("_id", _rank(F.col("_len"), F.col("_id")).alias("_rank"), "_norm",
                    digest(F.col("_norm")).alias("_digest")))

    groups = stored(_combine(rows, salts).groupBy("_digest").agg(
        F.count(F.lit(1)).alias("_contents"), F.max("_n").alias("_n"), F.max("_best").alias("_best"))
        .filter((F.col("_n") > 1) | (F.col("_contents") > 1)), "exact-groups")

    # Look-up, without text: only repeated digests are joined, replicated over a few
    # salts so that the rows of a hot text are spread over as many tasks.
    spread = 16
    single = groups.filter(F.col("_contents") == 1).select(
        "_digest", "_n", "_best", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("_spread"))
    light = rows.select("_id", "_rank", "_digest",
                        F.pmod(F.xxhash64("_id", "_rank"), F.lit(spread)).cast("int").alias("_spread"))
    collided = groups.filter(F.col("_contents") > 1).select("_digest")
    if collided.head(1):
        clash = rows.join(collided, "_digest", "left_semi")
        exact = clash.join(_combine(clash, salts), ["_digest", "_norm"])
        light = light.join(collided, "_digest", "left_anti")
        extra = exact.select("_id", "_rank", "_digest", "_n", "_best")
    else:
        extra = None
    found = light.join(single, ["_digest", "_spread"], "left").select("_id", "_rank", "_digest", "_n", "_best")
    if extra is not None:
        found = found.unionByName(extra)
    best = F.coalesce(F.col("_best"), F.col("_rank"))
    return found.select(
        F.col("_id").alias("doc_id"), _id_of(best).alias("keep_id"),
        F.coalesce(F.col("_n"), F.lit(1)).cast("long").alias("group_size"),
        (F.col("_rank") == best).alias("kept"), F.col("_digest").alias("digest"))
