"""One user per person, from user rows that share e-mails or ids.

Rows are linked through their values: a row joins its id with its e-mail, and whatever hangs together
is one person. So an e-mail that many rows share costs as many links as rows, not pairs of them.

The person keeps the id of the earliest row with one. Other fields take the value of the latest row
that has a known one (not NULL, empty or a placeholder); dates take the earliest. Rows are ordered by
created_at, rows without it being the earliest of all for the latest value and the last for the
earliest one; ties by user_id and the value. A row without id and e-mail is a person of its own;
such rows are one person if all their values are equal.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custarc.operators.components import connected

UNKNOWN = ("", "Others")
LATEST = ("email", "first_name", "last_name", "gender", "country", "lead_source", "phone")
EARLIEST = ("signup_date", "created_at")


@dataclass(frozen=True)
class People:
    """``users``: one row per person, with the columns of stg_user and person. ``ids`` and ``emails``:
    every user_id and e-mail that occurs, once, with its person and the person's email and user_id."""

    users: DataFrame
    ids: DataFrame
    emails: DataFrame


def _node(kind: str, value: str) -> Column:
    return F.concat(F.lit(f"{kind}:"), F.col(value))


def with_person(users: DataFrame, cut: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``users`` with person, the smallest node (id or e-mail) that a row hangs together with."""
    both = users.where("user_id IS NOT NULL AND email IS NOT NULL")
    links = both.select(_node("email", "email").alias("a"), _node("id", "user_id").alias("b"))
    roots = connected(links, cut)
    values = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in users.columns]
    alone = F.concat(F.lit("row:"), F.sha2(F.concat_ws("\n", *values), 256))
    named = users.withColumn("_node", F.coalesce(_node("id", "user_id"), _node("email", "email"), alone))
    found = named.join(roots, F.col("_node") == F.col("node"), "left")
    return found.withColumn("person", F.coalesce("root", "_node")).drop("_node", "node", "root")


def one_per_person(users: DataFrame, cut: Callable[[DataFrame, str], DataFrame]) -> People:
    """The people of stg_user. ``cut(df, name)`` stores what is read more than once."""
    rows = cut(with_person(users, cut), "user_rows")

    def latest(field: str) -> Column:
        known = F.col(field).isNotNull() & ~F.col(field).isin(*UNKNOWN)
        # NULL is the least, so a row without created_at counts as the earliest.
        order = F.struct("created_at", "user_id", field)
        # Without a known value, a placeholder is better than none.
        return F.coalesce(F.max_by(field, F.when(known, order)), F.max(field)).alias(field)

    first = F.struct(F.col("created_at").isNull(), F.col("created_at"), F.col("user_id"))
    picked = rows.groupBy("person").agg(
        F.min_by("user_id", F.when(F.col("user_id").isNotNull(), first)).alias("user_id"),
        *[latest(f) for f in LATEST],
        *[F.min(f).alias(f) for f in EARLIEST],
    )
    people = cut(picked.select("person", *users.columns), "people")
    of = people.select("person", F.col("user_id").alias("person_id"), F.col("email").alias("person_email"))

    def known_by(column: str) -> DataFrame:
        own = rows.where(F.col(column).isNotNull()).select(column, "person").distinct()
        return own.join(of, "person")

    return People(
        people,
        known_by("user_id").select("user_id", F.col("person_email").alias("email"), "person"),
        known_by("email").select("email", F.col("person_id").alias("user_id"), "person"),
    )
