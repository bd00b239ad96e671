"""Cleaning of text columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a missing value, a missing user id, a US currency prefix.
PLACEHOLDERS = ("null", "n/a", "na", "nan", "none")
UNKNOWN_USER_IDS = ("user_unknown", "", "null")
US_CURRENCY_PREFIX = "us"

# Words looked for in a description, in the order they are tried.
PLAN_WORDS = ("Basic", "Standard", "Premium")
LAST_PLAN = "Ultimate"
TYPE_WORDS = ("upgrade", "new", "downgrade", "renewal")


def capitalize_words(col: Column) -> Column:
    """Lower-case, then capitalise each whitespace-separated word; runs of whitespace become
    one space (``initcap`` alone keeps them and only breaks words at spaces)."""
    return F.initcap(F.regexp_replace(col, r"\s+", " "))


def is_placeholder(col: Column) -> Column:
    """NULL, or one of the words that stand for a missing value (compared untrimmed)."""
    return col.isNull() | F.lower(col).isin(*PLACEHOLDERS)


def handle_issue(col: Column, fill: str = "") -> Column:
    """Replace missing values by ``fill``, trim the rest, then capitalise the words."""
    return capitalize_words(F.when(is_placeholder(col), F.lit(fill)).otherwise(F.trim(col)))


def clean_email(col: Column) -> Column:
    """Trim, undo the ``_at_`` masking (case-sensitive), lower-case."""
    return F.lower(F.replace(F.trim(col), F.lit("_at_"), F.lit("@")))


def digits_only(col: Column) -> Column:
    return F.regexp_replace(col, "[^0-9]", "")


def null_if_in(col: Column, values: Iterable[str] = UNKNOWN_USER_IDS) -> Column:
    return F.when(~col.isin(*values), col)


def clean_currency(col: Column) -> Column:
    is_usd = F.lower(col).startswith(US_CURRENCY_PREFIX) | col.contains("$")
    return F.when(is_usd, F.lit("USD")).otherwise(F.trim(col))


def repair_transaction_type(
    kind: Column, description: Column, transaction_id: Column, renewal_first: bool = False
) -> Column:
    """Lower-cased type; a missing one is read from the description, then from the id.

    'new' is tried before 'renewal', which contains it, so a renewal is read as new unless
    ``renewal_first`` is set.
    """
    words = sorted(TYPE_WORDS, key=lambda w: w != "renewal") if renewal_first else TYPE_WORDS
    guess = F.coalesce(
        *[F.when(description.contains(w), F.lit(f"subscription_payment_{w}")) for w in words],
        F.when(transaction_id.contains("re"), F.lit("refund")),
    )
    cleaned = handle_issue(kind)
    return F.when(cleaned == "", guess).otherwise(F.lower(F.trim(cleaned)))


def infer_plan(description: Column) -> Column:
    found = [F.when(description.contains(p), F.lit(p)) for p in PLAN_WORDS]
    return F.coalesce(*found, F.lit(LAST_PLAN))


def infer_cycle(description: Column) -> Column:
    return F.when(description.contains("Monthly"), F.lit("Monthly")).otherwise(F.lit("Annual"))


def fill_empty(col: Column, fallback: Column) -> Column:
    """``fallback`` where the cleaned column is the empty string (NULL stays NULL)."""
    return F.when(col == "", fallback).otherwise(col)


def flag(col: Column) -> Column:
    """Boolean to 0/1 integer, NULL to 0."""
    return F.when(col, F.lit(1)).otherwise(F.lit(0))


def default_label(col: Column, label: str = "N/A") -> Column:
    return F.coalesce(col, F.lit(label))
