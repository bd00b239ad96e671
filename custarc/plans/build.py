"""From raw tables to stored star schema and marts."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from custarc.operators.identity import each_copy
from custarc.operators.people import People, one_per_person
from custarc.operators.quality import GRAIN, counted, load_report, repeated_keys
from custarc.plans import core, marts, retention, revenue, staging
from custarc.plans.intermediate import int_product_usage, int_subscription
from custarc.settings import Settings
from custarc.sinks.export import export_marts
from custarc.sinks.tables import cut_into, drop_folder, register_view, replace_table, scratch_folder
from custarc.sources.files import load_raw
from custarc.sources.raw import Sources


log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Models:
    """All models over one set of sources, each built once and lazily on first use.

    ``counted(df, name)`` is applied to each source once, where it is the side of a plan that keeps
    all its rows. ``store(df, name)`` is applied to every core table and mart. By default nothing is stored
    and a model is one plan from the sources; a store that writes and reads back makes the
    later models start from files.
    """

    spark: SparkSession
    sources: Sources
    settings: Settings = Settings()
    store: Callable[[DataFrame, str], DataFrame] = lambda df, name: df
    cut: Callable[[DataFrame, str], DataFrame] = lambda df, name: df
    counted: Callable[[DataFrame, str], DataFrame] = lambda df, name: df

    @cached_property
    def stg_user(self) -> DataFrame:
        return staging.stg_user(self.sources.users)

    @cached_property
    def stg_subscription(self) -> DataFrame:
        return staging.stg_subscription(self.sources.subscriptions)

    @cached_property
    def stg_transaction(self) -> DataFrame:
        return staging.stg_transaction(self.sources.transactions, self.settings)

    @cached_property
    def stg_support_ticket(self) -> DataFrame:
        return staging.stg_support_ticket(self.sources.support_tickets)

    @cached_property
    def stg_product_usage(self) -> DataFrame:
        return staging.stg_product_usage(self.sources.product_usage)

    @cached_property
    def people(self) -> People:
        return one_per_person(self.cut(self.counted(self.stg_user, "users"), "stg_user"), self.cut)

    @cached_property
    def user_keys(self) -> tuple[DataFrame, DataFrame]:
        """What events are looked up in: by id (user_id, email, user_sk) and by e-mail (email, user_sk)."""
        if self.settings.users == "reference":
            return self.dim_user, self.dim_user
        ids, emails = core.person_keys(self.people)
        return self.store(ids, "user_ids"), self.store(emails, "user_emails")

    @cached_property
    def int_product_usage(self) -> DataFrame:
        if self.settings.users == "reference":
            return int_product_usage(self.stg_product_usage, self.stg_user)
        return int_product_usage(self.stg_product_usage, *self.user_keys)

    @cached_property
    def int_subscription(self) -> DataFrame:
        return int_subscription(self.stg_subscription, self.stg_transaction)

    @cached_property
    def dim_date(self) -> DataFrame:
        return self.store(core.dim_date(self.spark, self.settings), "dim_date")

    @cached_property
    def dim_user(self) -> DataFrame:
        if self.settings.users == "reference":
            return self.store(core.dim_user(self.counted(self.stg_user, "users"), self.settings), "dim_user")
        return self.store(core.dim_person(self.people, self.settings), "dim_user")

    @cached_property
    def dim_subscription(self) -> DataFrame:
        subscriptions = int_subscription(self.counted(self.stg_subscription, "subscriptions"), self.stg_transaction)
        df = core.dim_subscription(subscriptions, self.user_keys[1], self.settings)
        return self.store(df, "dim_subscription")

    @cached_property
    def fact_transaction(self) -> DataFrame:
        df = core.fact_transaction(
            self.counted(self.stg_transaction, "transactions"), self.dim_subscription, self.user_keys[1], self.settings
        )
        return self.store(df, "fact_transaction")

    @cached_property
    def fact_support(self) -> DataFrame:
        tickets = self.counted(self.stg_support_ticket, "support_tickets")
        df = core.fact_support(tickets, self.user_keys[1], self.settings)
        return self.store(df, "fact_support")

    @cached_property
    def fact_product_usage_weighted(self) -> DataFrame:
        """What the usage marts read; the stored fact is its copies written out."""
        ids, emails = self.user_keys
        usage = self.counted(self.stg_product_usage, "product_usage")
        df = core.fact_product_usage_weighted(usage, ids, self.settings, emails)
        return self.cut(df, "fact_product_usage_weighted")

    @cached_property
    def fact_product_usage(self) -> DataFrame:
        return self.store(each_copy(self.fact_product_usage_weighted), "fact_product_usage")

    @cached_property
    def mart_acquisition(self) -> DataFrame:
        df = marts.mart_acquisition(self.dim_user, self.fact_product_usage_weighted, self.settings)
        return self.store(df, "mart_acquisition")

    @cached_property
    def mart_engagement(self) -> DataFrame:
        df = marts.mart_engagement(self.fact_product_usage_weighted, self.settings)
        return self.store(df, "mart_engagement")

    @cached_property
    def mart_support(self) -> DataFrame:
        return self.store(marts.mart_support(self.fact_support, self.settings), "mart_support")

    @cached_property
    def mart_retention(self) -> DataFrame:
        df = retention.mart_retention(self.dim_subscription, self.fact_transaction, self.settings)
        return self.store(df, "mart_retention")

    @cached_property
    def mart_revenue(self) -> DataFrame:
        df = revenue.mart_revenue(
            self.fact_transaction, self.dim_subscription, self.settings, self.cut
        )
        return self.store(df, "mart_revenue")


VIEWS = (
    "stg_user", "stg_subscription", "stg_transaction", "stg_support_ticket",
    "stg_product_usage", "int_product_usage", "int_subscription",
)
# Each phase needs the ones before it; the models of a phase don't need each other.
PHASES = (
    ("dim_date", "dim_user"),
    ("user_keys",),
    ("dim_subscription", "fact_support", "fact_product_usage_weighted"),
    ("fact_transaction", "fact_product_usage", "mart_acquisition", "mart_engagement", "mart_support"),
    ("mart_retention", "mart_revenue"),
)
TABLES = (
    "dim_date", "dim_user", "dim_subscription", "fact_transaction", "fact_support",
    "fact_product_usage", "mart_acquisition", "mart_engagement", "mart_support",
    "mart_retention", "mart_revenue",
)


KEY_ORDER = ("subscription_sk", "valid_from")


def in_key_order(df: DataFrame) -> DataFrame:
    """dim_subscription in key order from file to file. The ranges are cut over key and a hash of the
    row, so that a key with many rows can be split. ``df`` is read twice, once to find the ranges."""
    tie = F.xxhash64(*df.columns)
    order = [*map(F.col, KEY_ORDER), F.col("_tie")]
    return df.withColumn("_tie", tie).repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie")


def build(
    spark: SparkSession,
    sources: Sources,
    location: str,
    settings: Settings = Settings(),
    counts: dict[str, int] | None = None,
) -> dict[str, DataFrame]:
    """Register the views, replace every table under ``location`` and return the tables.

    Each table is computed from the stored ones before it, so losing executors never costs
    more than the tables being written, and a table that can't be written stays as it was. Tables that
    don't need each other are written by concurrent jobs, so one's last tasks leave no cores idle. ``counts``
    receives the rows of every source and table, which are counted on the way.
    """
    scratch = scratch_folder(spark)
    cut = cut_into(scratch)
    seen: dict[str, Observation] = {}

    def count(df: DataFrame, name: str) -> DataFrame:
        df, seen[name] = counted(df, name)
        return df

    def store(df: DataFrame, name: str) -> DataFrame:
        if name == "dim_subscription":
            df = in_key_order(cut(df, name))
        return replace_table(count(df, name), location, name)

    models = Models(spark, sources, settings, store, cut, count)
    for name in VIEWS:
        register_view(getattr(models, name), name)
    try:
        for phase in PHASES:
            with ThreadPoolExecutor(len(phase)) as pool:
                list(pool.map(lambda name: getattr(models, name), phase))
        tables = {name: getattr(models, name) for name in TABLES}
    finally:
        drop_folder(spark, scratch)
    if counts is not None:
        counts.update({name: one.get["rows"] for name, one in seen.items()})
    return tables


def check_tables(spark: SparkSession, tables: dict[str, DataFrame], location: str) -> dict[str, int]:
    """Store the repeated keys of all tables as the table repeated_keys, log how many there are, and
    return the tables with any."""
    found = replace_table(repeated_keys(tables), location, "repeated_keys")
    repeated = {r["table"]: r["n"] for r in found.groupBy("table").agg(F.count("*").alias("n")).collect()}
    for name, n in repeated.items():
        log.warning("%s: %d repeated keys (%s)", name, n, ", ".join(GRAIN[name]))
    return repeated


class ExportError(RuntimeError):
    """Some marts could not be exported; ``result`` says which."""

    def __init__(self, result: dict[str, str]):
        failed = sorted(n for n, state in result.items() if state in ("missing", "failed"))
        super().__init__(f"not exported: {', '.join(failed)}")
        self.result = result


def run(
    spark: SparkSession,
    data_folder: str,
    location: str,
    export_folder: str | None = None,
    settings: Settings = Settings(),
    **options: str,
) -> dict[str, DataFrame]:
    """Load a folder of raw files, build everything and export the marts. Row counts of the raw
    and the built tables are logged, repeated keys stored; a failed export raises ExportError
    after the others are done. ``options`` are those of the CSV reader."""
    raw = load_raw(spark, data_folder, **options)
    if not raw:
        raise ValueError(f"no table in {data_folder}")
    counts: dict[str, int] = {}
    tables = build(spark, Sources.of(raw), location, settings, counts)
    # Sources are counted while they are built; only other tables of the folder are read for it.
    for row in load_report(raw, known=counts).collect():
        log.info("%s.%s: %d rows", *row)
    for name in tables:
        log.info("%s: %d rows", name, counts[name])
    check_tables(spark, tables, location)
    if export_folder:
        result = export_marts(spark, location, export_folder)
        if {"missing", "failed"} & set(result.values()):
            raise ExportError(result)
    return tables
