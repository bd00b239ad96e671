"""Filling in the missing half of (user_id, user_email) on usage events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custarc.operators.joins import lookup_left

# Fixed value: user ids containing this are anonymous and get no e-mail.
ANONYMOUS_MARK = "ano"


def _with_email(usage: DataFrame, users: DataFrame) -> DataFrame:
    """Adds found_email: the own e-mail, else the one of the user id unless anonymous."""
    by_id = users.select(F.col("user_id").alias("_id"), F.col("email").alias("_email_of_id"))
    found = F.when(
        F.col("user_email").isNull() & ~F.col("user_id").contains(ANONYMOUS_MARK),
        F.col("_email_of_id"),
    ).otherwise(F.col("user_email"))
    joined = lookup_left(usage, by_id, "user_id", "_id", ["event_id"])
    return joined.withColumn("found_email", found).drop("_email_of_id")


def repair_identity(usage: DataFrame, users: DataFrame, emails: DataFrame | None = None) -> DataFrame:
    """user_id: own, else that of the e-mail; user_email: own, else that of the id.

    Both lookups run for every row, so a row is repeated for each user sharing its e-mail
    and for each user sharing its id. ``emails`` (email, user_id) is looked up instead of ``users``
    where it is given.
    """
    by_email = (users if emails is None else emails).select(F.col("email").alias("_email"), F.col("user_id").alias("_id_of_email"))
    both = lookup_left(_with_email(usage, users), by_email, "user_email", "_email", ["event_id"])
    return both.withColumns(
        {
            "user_id": F.coalesce("user_id", "_id_of_email"),
            "user_email": F.col("found_email"),
        }
    ).drop("found_email", "_id_of_email")


def weighted_usage(usage: DataFrame, users: DataFrame, emails: DataFrame | None = None) -> DataFrame:
    """``repair_identity`` followed by the user lookup, with one e-mail join instead of two.

    An event with an own e-mail shared by k users is repeated k times by the repair and each
    copy meets k users. Both joins have the same key, so one join brings the users together
    with k: an event stays k rows, and ``copies`` says that each stands for k equal ones.
    ``users`` has user_id, email and user_sk; ``emails`` (email, user_sk) is looked up instead of it
    where it is given.
    """
    by_email = users if emails is None else emails
    shared = by_email.where("email IS NOT NULL").groupBy("email").agg(F.count("*").alias("_k"))
    by_email = by_email.select("email", "user_sk").join(shared, "email")
    own_email = F.col("user_email").isNotNull()
    looked_up = lookup_left(
        _with_email(usage, users).withColumn("_own", own_email),
        by_email,
        "found_email",
        "email",
        ["event_id"],
    )
    copies = F.when(F.col("_own"), F.coalesce("_k", F.lit(1))).otherwise(F.lit(1)).cast("long")
    return looked_up.withColumn("copies", copies).drop("_own", "_k", "found_email")


def each_copy(df: DataFrame, copies: str = "copies") -> DataFrame:
    """Every row as often as its column ``copies`` says, without that column."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).drop(copies, "_copy")
