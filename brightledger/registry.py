"""Named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from brightledger.functions.scoring import named
from brightledger.operators import checks
from brightledger.operators.sections import union_sections
from brightledger.plans import alternative, gold, insights, orders, silver, staging
from brightledger.plans.bank import Bank
from brightledger.rules import contracts
from brightledger.session import prepared, shared_folder
from brightledger.sources.driver_tables import bank_frames, read_table, shop_frames
from brightledger.sources.published import as_view, content_mark, passthrough, read_published, write_table
from brightledger.sources.reference import SCHEMAS, BuiltinReferences, load_orders_demo, load_reference

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, whole numbers as bigint and moments as text, so that
    results can be compared across engines."""

    def cast(field: T.StructField):
        kind = field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            return F.col(field.name).cast("bigint").alias(field.name)
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.col(field.name).cast("string").alias(field.name)
        return F.col(field.name)

    return df.select(*[cast(field) for field in df.schema.fields])


# By session and folder of tables: the mark of the tables when the bank was made, and the bank.
_BANKS: dict[tuple[str, str], tuple[str, Bank]] = {}


def reporting_bank(spark: SparkSession, folder: str) -> Bank:
    """The bank that reports read: its roll-ups lie in the shared folder, and every report over
    the same tables starts at those files. When a given table has changed since, the bank is
    made anew over the same store, which replaces the roll-ups that follow from that table and
    no others."""
    key = (spark.sparkContext.applicationId, folder)
    mark = content_mark(spark, bank_frames(spark, folder).sources())
    if key not in _BANKS or _BANKS[key][0] != mark:
        store = _BANKS[key][1].store if key in _BANKS else f"{shared_folder(spark)}/bank-{uuid4().hex}"
        _BANKS[key] = (mark, Bank.over(spark, folder, store=store))
    return _BANKS[key][1]


def bank_table(name: str, profile: str = "main") -> Query:
    """A table of the cleaning or roll-up layer, computed from the given tables each time."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        return portable(Bank.over(spark, folder, profile=profile)[name])

    return query


def bank_report(name: str, *steps) -> Query:
    """A report, or models applied one after the other to a stored part."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        df = reporting_bank(spark, folder)[name]
        for step in steps:
            df = step(df)
        return portable(df)

    return query


def bank_queries() -> dict[str, Query]:
    named = {f"stg_{name}": bank_table(name) for name in staging.MODELS}
    named |= {f"int_{name}": bank_table(name) for name in silver.MODELS}
    named |= {name: bank_report(name) for name in gold.MODELS}
    for step in (
        gold.risk_heatmap,
        gold.retention_insights,
        gold.digital_transformation_metrics,
        gold.digital_preference_segments,
    ):
        named[step.__name__] = bank_report("customer_health", step)
    named["channel_product_effectiveness"] = lambda spark, folder: portable(
        reporting_bank(spark, folder).call(gold.channel_product_effectiveness)
    )
    named |= {f"alt_stg_{name}": bank_table(name, "alt") for name in ("customers_360", "loans", "customer_phones")}
    named |= {f"alt_int_{name}": bank_table(name, "alt") for name in alternative.ROLL_UPS}
    named |= {f"alt_{name}": bank_table(name, "alt") for name in alternative.REPORTS}
    return named


def shop_table(name: str, frames) -> DataFrame:
    """A table of the order demo, built from the demo's inputs."""

    def made(other: str) -> DataFrame:
        return shop_table(other, frames)

    if name in frames:
        return frames[name]
    return {
        "stg_customers": lambda: orders.stg_customers(made("raw_customers")),
        "stg_orders": lambda: orders.stg_orders(made("raw_orders")),
        "stg_payments": lambda: orders.stg_payments(made("raw_payments")),
        "customers": lambda: orders.customers(made("stg_customers"), made("stg_orders"), made("stg_payments")),
        "orders": lambda: orders.orders(made("stg_orders"), made("stg_payments")),
        "published_customers": lambda: orders.published_customers(made("shop_customers")),
        "published_orders": lambda: orders.published_orders(made("shop_orders")),
        "customer_orders": lambda: orders.customer_orders(made("published_customers"), made("published_orders")),
        "customer_summary": lambda: orders.customer_summary(made("customer_orders")),
        "numeric_grid_summary": lambda: orders.numeric_grid_summary(made("pairs"), step=1),
        "numeric_grid_filtered": lambda: orders.numeric_grid_summary(made("pairs")),
    }[name]()


# Registered name: table of the order demo.
SHOP_TABLES = {
    "order_customers": "customers",
    "order_payments_pivot": "orders",
    "shop_stg_customers": "stg_customers",
    "shop_stg_orders": "stg_orders",
    "shop_stg_payments": "stg_payments",
    "published_customers": "published_customers",
    "published_orders": "published_orders",
    "customer_orders": "customer_orders",
    "customer_summary": "customer_summary",
    "numeric_grid_summary": "numeric_grid_summary",
    "numeric_grid_filtered": "numeric_grid_filtered",
}


def shop_queries() -> dict[str, Query]:
    def over(name: str) -> Query:
        return lambda spark, folder: portable(shop_table(name, shop_frames(spark, folder)))

    return {
        **{registered: over(name) for registered, name in SHOP_TABLES.items()},
        "stored_customer_summary": stored_customer_summary,
        "named_customer_summary": named_customer_summary,
        "csv_order_customers": csv_order_customers,
        "csv_reference_tables": csv_reference_tables,
        **{f"csv_stg_{name}": csv_referenced(name) for name in ("accounts", "customers_360", "customer_addresses")},
    }


def stored_customer_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The published customers and orders are written to the shared folder, and the
    summary is built by a reader that knows only where they are."""
    frames, place = shop_frames(spark, folder), f"{shared_folder(spark)}/published-{uuid4().hex}"
    for name in ("published_customers", "published_orders"):
        write_table(shop_table(name, frames), f"{place}/{name}")
    customers, placed = (read_published(spark, f"{place}/{n}") for n in ("published_customers", "published_orders"))
    return portable(orders.customer_summary(orders.customer_orders(customers, placed)))


def named_customer_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The order demo's customers and orders under public names, and the summary by a reader
    that knows nothing but the names."""
    frames = shop_frames(spark, folder)
    for name in contracts.PUBLIC:
        as_view(shop_table(name, frames), name, contracts.PUBLIC)
    customers, placed = (read_published(spark, name) for name in contracts.PUBLIC)
    return portable(orders.customer_summary(orders.customer_orders(customers, placed)))


def csv_order_customers(spark: SparkSession, folder: str) -> DataFrame:
    """The order demo from typed CSV files."""
    frames, place = shop_frames(spark, folder), f"{shared_folder(spark)}/csv-{uuid4().hex}"
    for name in ("raw_customers", "raw_orders", "raw_payments"):
        frames[name].write.option("header", True).csv(f"{place}/{name}.csv")
    return portable(shop_table("customers", load_orders_demo(spark, place)))


def csv_referenced(name: str) -> Query:
    """A cleaned table joined to reference tables that were written as CSV and loaded under
    their declared schemas."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        place = f"{shared_folder(spark)}/references-{uuid4().hex}"
        builtin = BuiltinReferences(spark)
        for table, df in builtin.items():
            declared = T.StructType.fromDDL(SCHEMAS[table])
            columns = [
                F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in declared
            ]
            df.select(*columns).write.option("header", True).csv(f"{place}/{table}.csv")
        loaded = {table: load_reference(spark, place, table) for table in builtin}
        return portable(Bank(bank_frames(spark, folder), loaded)[name])

    return query


def part_as_reference(part: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of a reference table's shape, one per part, its columns from last to first."""

    def value(at: int, kind: T.DataType) -> str:
        if isinstance(kind, T.StringType):
            return f"concat(p_type, ' {at}')" if at else "concat('K', CAST(p_partkey AS STRING))"
        if isinstance(kind, T.BooleanType):
            return f"p_size % 3 = {at % 3}"
        if isinstance(kind, T.DateType):
            return "date_add(DATE '2024-01-01', p_size)"
        return f"CAST(p_size * {'1.25' if isinstance(kind, T.DecimalType) else at} AS {kind.simpleString()})"

    return part.selectExpr(*[f"{value(at, f.dataType)} AS {f.name}" for at, f in reversed(list(enumerate(schema)))])


def reference_totals(name: str, df: DataFrame) -> DataFrame:
    """One row on a reference table: its rows and keys, and totals by type."""

    def of(kind: type, text: str) -> str:
        found = [text.format(f.name) for f in df.schema if isinstance(f.dataType, kind)]
        return " + ".join(found)

    flags, dates = of(T.BooleanType, "count_if({})"), [f.name for f in df.schema if isinstance(f.dataType, T.DateType)]
    return df.agg(
        F.lit(name).alias("table_name"),
        *named(
            entries="count(*)",
            keys=f"count(DISTINCT {df.columns[0]})",
            signs=of(T.StringType, "sum(length({}))"),
            whole_total=of(T.IntegerType, "sum({})") or "CAST(NULL AS BIGINT)",
            exact_total=of(T.DecimalType, "sum({})") or "CAST(NULL AS DOUBLE)",
            flags=flags or "CAST(NULL AS BIGINT)",
            last_day=f"max({dates[0]})" if dates else "CAST(NULL AS DATE)",
        ),
    )


def csv_reference_tables(spark: SparkSession, folder: str) -> DataFrame:
    """All reference schemas: every table is written as CSV with its columns in another order,
    loaded under its declared schema, and summed up."""
    part, place = read_table(spark, folder, "part"), f"{shared_folder(spark)}/references-{uuid4().hex}"
    totals = []
    for name in contracts.REFERENCE_KEYS:
        part_as_reference(part, T.StructType.fromDDL(SCHEMAS[name])).write.option("header", True).csv(f"{place}/{name}.csv")
        totals.append(reference_totals(name, load_reference(spark, place, name)))
    return portable(union_sections(*totals))


def over_tables(step, *tables: str) -> Query:
    """A step applied to given tables as they are."""
    return lambda spark, folder: portable(step(*[read_table(spark, folder, table) for table in tables]))


def insight_queries() -> dict[str, Query]:
    return {
        "account_band_mix": over_tables(insights.account_band_mix, "customer"),
        "market_segment_share": over_tables(insights.market_segment_share, "customer"),
        "latest_event_per_user": over_tables(insights.latest_event_per_user, "events"),
        "customer_activity_alignment": over_tables(insights.customer_activity_alignment, "orders", "events"),
        "customer_versions_alignment": over_tables(insights.customer_versions_alignment, "customer", "orders", "events"),
        "recent_event_counts": over_tables(insights.recent_event_counts, "events"),
        "order_value_steps": over_tables(insights.order_value_steps, "orders"),
        "return_flag_pivot": over_tables(insights.return_flag_pivot, "lineitem"),
        "supplier_scores": over_tables(insights.supplier_scores, "supplier", "lineitem"),
        "customer_order_habits": over_tables(insights.customer_order_habits, "orders"),
        "order_sections": over_tables(insights.order_sections, "orders", "supplier"),
        "passthrough": over_tables(passthrough, "nation"),
    }


def check_queries() -> dict[str, Query]:
    def bank(tables: dict) -> Query:
        def query(spark: SparkSession, folder: str) -> DataFrame:
            made = reporting_bank(spark, folder)
            return checks.run_all_checks({name: made[name] for name in tables}, tables)

        return query

    def demo(spark: SparkSession, folder: str) -> DataFrame:
        frames = shop_frames(spark, folder)
        tables = {name: shop_table(name, frames) for name in contracts.ORDER_DEMO}
        return checks.run_all_checks(tables, contracts.ORDER_DEMO)

    def line_ids(lineitem: DataFrame) -> DataFrame:
        return checks.unique_values(lineitem.selectExpr("l_orderkey * 10 + l_linenumber AS line_id"), "line_id")

    def event_values(events: DataFrame) -> DataFrame:
        kept = events.selectExpr("event_id", "user_id", "CASE WHEN event_type <> 'signup' THEN value END AS value")
        return checks.missing(kept, "value").select("event_id", "user_id")

    def event_types(events: DataFrame) -> DataFrame:
        return checks.disallowed(events.select("event_id", "event_type"), "event_type", ("click", "view", "purchase"))

    def orphan_events(events: DataFrame, customer: DataFrame) -> DataFrame:
        owned = events.selectExpr("event_id", "user_id * 11 AS customer_id")
        return checks.orphans(owned, "customer_id", customer, "c_custkey")

    return {
        "checks_staging": bank(contracts.STAGING),
        "checks_roll_ups": bank(contracts.ROLL_UPS),
        "checks_reports": bank(contracts.REPORTS),
        "checks_order_demo": demo,
        "check_unique_line_ids": over_tables(line_ids, "lineitem"),
        "check_missing_event_values": over_tables(event_values, "events"),
        "check_event_types": over_tables(event_types, "events"),
        "check_orphan_events": over_tables(orphan_events, "events", "customer"),
    }


def all_queries() -> dict[str, Query]:
    def with_settings(query: Query) -> Query:
        return lambda spark, folder: query(prepared(spark), folder)

    named = {**shop_queries(), **bank_queries(), **insight_queries(), **check_queries()}
    return {name: with_settings(query) for name, query in named.items()}
