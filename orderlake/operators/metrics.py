"""Governed metrics: declared measures, dimensions and metrics, and the query over them.

`metric_query(star, ["revenue", "avg_order_value"], ["metric_time__month", "customer__customer_state"])`
gives one row per group. All measures live on the order fact, so any set of metrics is one aggregate.
Ratios divide totals of the asked grain; they are never averaged up from a finer one.

A cumulative metric is the running total up to the end of each period, as far as the time spine goes.
With `every_period`, days without orders carry the total too: each group then has a row for every period
from its first one up to the last one of all orders, where the other metrics are null. By default a row
stands only where the group has orders. Without a time dimension it is the total.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderlake.functions.calendar import GRAINS, STEPS, period_start
from orderlake.functions.numbers import MONEY_TOTAL, money_sum, ratio


@dataclass(frozen=True)
class Measure:
    """An aggregate over one column of the order fact."""

    column: str
    aggregate: Callable[[Column], Column]


def total_whole(column: Column) -> Column:
    return F.sum(column).cast("bigint")


def total_true(flag: Column) -> Column:
    return F.sum(F.when(flag, 1).otherwise(0)).cast("bigint")


MEASURES = {
    "order_count": Measure("order_id", F.count),
    "revenue_sum": Measure("gross_revenue", money_sum),
    "item_revenue_sum": Measure("gross_item_revenue", money_sum),
    "freight_sum": Measure("total_freight", money_sum),
    "payment_sum": Measure("total_payment_amount", money_sum),
    "item_count_sum": Measure("item_count", total_whole),
    "canceled_count": Measure("is_canceled", total_true),
    "delivered_count": Measure("is_delivered", total_true),
    "unique_customer_count": Measure("customer_unique_id", F.count_distinct),
}


@dataclass(frozen=True)
class Metric:
    """A named number.

    simple and cumulative name a measure; ratio names two metrics to divide; derived names the
    metrics that `formula` combines.
    """

    label: str
    kind: str
    description: str
    inputs: tuple[str, ...]
    formula: Callable[..., Column] | None = None


METRICS = {
    "revenue": Metric("Revenue", "simple", "All sales: item prices plus freight", ("revenue_sum",)),
    "item_revenue": Metric("Item Revenue", "simple", "Item prices alone", ("item_revenue_sum",)),
    "freight_cost": Metric("Freight Cost", "simple", "Freight that customers paid", ("freight_sum",)),
    "order_count": Metric("Order Count", "simple", "Orders placed", ("order_count",)),
    "items_sold": Metric("Items Sold", "simple", "Order lines over all orders", ("item_count_sum",)),
    "unique_customers": Metric("Unique Customers", "simple", "Persons who ordered", ("unique_customer_count",)),
    "canceled_orders": Metric("Canceled Orders", "simple", "Orders that were canceled", ("canceled_count",)),
    "delivered_orders": Metric("Delivered Orders", "simple", "Orders that arrived", ("delivered_count",)),
    "avg_order_value": Metric("Average Order Value", "ratio", "Revenue per order", ("revenue", "order_count")),
    "avg_items_per_order": Metric("Average Items per Order", "ratio", "Lines per order", ("items_sold", "order_count")),
    "cancellation_rate": Metric(
        "Cancellation Rate", "ratio", "Share of orders canceled", ("canceled_orders", "order_count")
    ),
    "delivery_completion_rate": Metric(
        "Delivery Completion Rate", "ratio", "Share of orders delivered", ("delivered_orders", "order_count")
    ),
    "freight_pct_of_revenue": Metric(
        "Freight % of Revenue", "ratio", "Freight as a fraction of revenue", ("freight_cost", "revenue")
    ),
    "revenue_per_customer": Metric(
        "Revenue per Customer", "ratio", "Revenue per person who ordered", ("revenue", "unique_customers")
    ),
    "net_revenue": Metric(
        "Net Revenue",
        "derived",
        "Revenue less freight",
        ("revenue", "freight_cost"),
        lambda revenue, freight_cost: (revenue - freight_cost).cast(MONEY_TOTAL),
    ),
    "cumulative_revenue": Metric("Cumulative Revenue", "cumulative", "Running total of revenue", ("revenue_sum",)),
}

TIME_COLUMN = "order_date_key"
TIME_DIMENSIONS = ("metric_time", "order_date")
CUSTOMER_JOIN_KEY = "customer_key"

# What results can be grouped by: name -> column of the order fact, or of the customer dimension.
ORDER_DIMENSIONS = {
    "order": "order_id",
    "customer": "customer_key",
    "order_status": "order_status",
    "is_delivered": "is_delivered",
    "is_canceled": "is_canceled",
    "payment_type": "primary_payment_type",
    "is_multi_payment_method": "is_multi_payment_method",
}
CUSTOMER_DIMENSIONS = {
    "customer_state": "state",
    "customer_city": "city",
    "customer_zip_prefix": "zip_code_prefix",
}
ORDER_PREFIXES = ("order", "orders")
CUSTOMER_PREFIXES = ("customer", "customers")


@dataclass(frozen=True)
class GroupBy:
    """One resolved group-by name; the result column keeps the name as it was asked for."""

    name: str
    column: str
    grain: str | None = None
    of_customer: bool = False

    def value(self) -> Column:
        value = F.col(self.column)
        return period_start(value, self.grain) if self.grain else value


def resolve_group(name: str) -> GroupBy:
    """`metric_time__month`, `order__payment_type`, `customer__customer_state`, or without prefix."""
    first, *rest = name.split("__")
    if first in ORDER_PREFIXES and rest:
        first, *rest = rest
        if first in ("metric_time", *CUSTOMER_DIMENSIONS):
            raise ValueError(f"unknown dimension {name!r}")
    elif first in CUSTOMER_PREFIXES and rest:
        first, *rest = rest
        if first not in CUSTOMER_DIMENSIONS:
            raise ValueError(f"unknown dimension {name!r}")
    if first in TIME_DIMENSIONS and len(rest) <= 1:
        grain = rest[0] if rest else "day"
        if grain in GRAINS:
            return GroupBy(name, TIME_COLUMN, grain)
    elif not rest and first in ORDER_DIMENSIONS:
        return GroupBy(name, ORDER_DIMENSIONS[first])
    elif not rest and first in CUSTOMER_DIMENSIONS:
        return GroupBy(name, CUSTOMER_DIMENSIONS[first], of_customer=True)
    raise ValueError(f"unknown dimension {name!r}")


def measures_of(name: str) -> set[str]:
    """Measures that a metric is made of. The name of a measure stands for itself."""
    if name not in METRICS:
        if name in MEASURES:
            return {name}
        raise ValueError(f"unknown metric {name!r}")
    metric = METRICS[name]
    if metric.kind in ("simple", "cumulative"):
        return {*metric.inputs}
    return set().union(*map(measures_of, metric.inputs))


def value_of(name: str) -> Column:
    """A metric as an expression over aggregated measures, or running totals of them."""
    metric = METRICS.get(name)
    if metric is None:
        return F.col(measure_column(name))
    if metric.kind == "cumulative":
        return F.col(running_column(metric.inputs[0]))
    if metric.kind == "simple":
        return F.col(measure_column(metric.inputs[0]))
    inputs = map(value_of, metric.inputs)
    return ratio(*inputs) if metric.kind == "ratio" else metric.formula(*inputs)


def measure_column(measure: str) -> str:
    return f"measure {measure}"


def running_column(measure: str) -> str:
    return f"running {measure}"


def metric_query(
    star,
    metrics: Iterable[str],
    group_by: Iterable[str] = (),
    every_period: bool = False,
    since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """Metrics by group; one row in all without a group. Filter, sort or limit the result as needed.

    With `since` and `until`, ISO dates, only orders of days from the one up to, but without, the other
    count; facts stored by month are then read for these months alone. A running total still holds what
    was before `since`, and is given for periods that begin no earlier than the one of `since`.

    A running total has a row where its group has orders; with `every_period`, also for each period
    in between and up to the last one with any order, which is groups times periods.
    """
    metrics, groups = list(metrics), [resolve_group(name) for name in group_by]
    if not metrics:
        raise ValueError("no metric was asked for")
    measures = sorted(set().union(*map(measures_of, metrics)))
    keys = [group.name for group in groups]

    running = sorted({METRICS[m].inputs[0] for m in metrics if m in METRICS and METRICS[m].kind == "cumulative"})
    facts = grouped_facts(star, groups, [MEASURES[m].column for m in measures], None if running else since, until)
    result = facts.groupBy(*keys).agg(
        *(MEASURES[m].aggregate(F.col(f"fact {MEASURES[m].column}")).alias(measure_column(m)) for m in measures)
    )
    if running:
        result = with_running_totals(star, result, groups, measures, running, every_period, until)
        if since:
            result = result.filter(on_or_after(groups, since))
    return result.select(*(F.col(f"`{k}`") for k in keys), *(value_of(m).alias(m) for m in metrics))


def on_or_after(groups: list[GroupBy], since: str) -> Column:
    times = [g for g in groups if g.grain]
    if not times:
        raise ValueError("a running total since a day takes a time dimension")
    return F.col(times[0].name) >= period_start(F.lit(since).cast("date"), times[0].grain)


def in_range(facts: DataFrame, since: str | None, until: str | None) -> DataFrame:
    if since:
        facts = facts.filter(F.col(TIME_COLUMN) >= F.lit(since).cast("date"))
    return facts.filter(F.col(TIME_COLUMN) < F.lit(until).cast("date")) if until else facts


def grouped_facts(
    star, groups: list[GroupBy], columns: list[str], since: str | None = None, until: str | None = None
) -> DataFrame:
    """Order facts with a column per group-by, and the wanted fact columns under their own prefix.

    Attributes of the customer come by a left join on the customer key, which is unique there.
    """
    of_order = [g.column for g in groups if not g.of_customer]
    of_customer = [g for g in groups if g.of_customer]
    join_key = [CUSTOMER_JOIN_KEY] if of_customer else []
    day = [TIME_COLUMN] if since or until else []
    facts = in_range(star.order_facts([*of_order, *columns, *join_key, *day], since, until), since, until)
    if of_customer:
        attributes = dict.fromkeys(g.column for g in of_customer)
        facts = facts.join(star["dim_customers"].select(CUSTOMER_JOIN_KEY, *attributes), CUSTOMER_JOIN_KEY, "left")
    return facts.select(
        *(g.value().alias(g.name) for g in groups),
        *(F.col(c).alias(f"fact {c}") for c in dict.fromkeys(columns)),
    )


def with_running_totals(
    star,
    totals: DataFrame,
    groups: list[GroupBy],
    measures: list[str],
    running: list[str],
    every_period: bool,
    until: str | None = None,
) -> DataFrame:
    """Add running totals of some measures.

    Facts are summed per group and period before; the window sees those sums only, so its longest
    partition is the number of periods. A row fills the periods up to the next row of its group.
    """
    times = [g for g in groups if g.grain]
    if not times:
        return totals.withColumns({running_column(m): F.col(measure_column(m)) for m in running})
    if len(times) > 1:
        raise ValueError("a cumulative metric takes one time dimension")
    time = times[0]
    others = [g.name for g in groups if g is not time]

    in_order = W.partitionBy(*others).orderBy(time.name)
    so_far = in_order.rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = totals.filter(F.col(time.name).isNotNull()).withColumns(
        {running_column(m): F.sum(measure_column(m)).over(so_far).cast(MONEY_TOTAL) for m in running}
    )
    if every_period:
        summed = with_every_period(star, summed, time, F.lead(time.name).over(in_order), measures, running, until)
    on_spine = star["time_spine"].select(period_start(F.col("date_day"), time.grain).alias(time.name))
    return summed.join(on_spine, time.name, "left_semi")


def with_every_period(
    star,
    summed: DataFrame,
    time: GroupBy,
    following: Column,
    measures: list[str],
    running: list[str],
    until: str | None = None,
) -> DataFrame:
    """Repeat each row, without its measures, for the periods before the group's next one."""
    last = in_range(star.order_facts([TIME_COLUMN], None, until), None, until).agg(period_start(F.max(TIME_COLUMN), time.grain)).scalar()
    step = F.expr(STEPS[time.grain])
    to_next = F.sequence(time.name, "following", step)
    periods = F.when(F.col("following").isNull(), F.sequence(F.col(time.name), last, step)).otherwise(
        F.slice(to_next, 1, F.size(to_next) - 1)
    )
    filled = summed.withColumn("following", following).withColumn("period", F.explode(periods))
    own = F.col("period") == F.col(time.name)
    kept = {measure_column(m): F.when(own, F.col(measure_column(m))) for m in measures}
    return filled.withColumns(kept).withColumn(time.name, F.col("period")).select(*summed.columns)


def unique_customers_by_grain(star, numbers: DataFrame, grains: Iterable[str] = GRAINS) -> DataFrame:
    """(grain, period, unique_customers) for several grains from one pass over the orders.

    numbers: (customer_unique_id, number), each person with a whole number of its own, near to others.
    Persons of a day are bits of a bitmap for each 32,768 numbers; those of longer periods are their
    union, so that no grain counts from the orders again. A bitmap takes 4 KiB however few bits are
    set: it pays where numbers are dense and days have many persons.
    """
    facts = star.order_facts([TIME_COLUMN, "customer_unique_id"])
    seen = facts.join(numbers, "customer_unique_id").select(
        F.col(TIME_COLUMN).alias("day"),
        F.bitmap_bucket_number("number").alias("part"),
        F.bitmap_bit_position("number").alias("bit"),
    )
    # A day without persons known by name still has its row.
    days = facts.select(F.col(TIME_COLUMN).alias("day")).distinct()
    daily = seen.groupBy("day", "part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    daily = daily.unionByName(days, allowMissingColumns=True)
    periods = F.array(*(F.struct(F.lit(g).alias("grain"), period_start(F.col("day"), g).alias("period")) for g in grains))
    each = daily.select(F.explode(periods).alias("of"), "part", "bits")
    merged = each.groupBy("of.grain", "of.period", "part").agg(F.bitmap_or_agg("bits").alias("bits"))
    persons = F.when(F.col("part").isNotNull(), F.bitmap_count("bits")).otherwise(0)
    return merged.groupBy("grain", "period").agg(F.sum(persons).cast("bigint").alias("unique_customers"))


def list_metrics(spark: SparkSession) -> DataFrame:
    """The catalogue: name, label, type and description of every metric."""
    rows = [(name, m.label, m.kind, m.description) for name, m in METRICS.items()]
    return spark.createDataFrame(rows, "name string, label string, type string, description string")


def list_dimensions(spark: SparkSession) -> DataFrame:
    """Every name that results can be grouped by, and the model it comes from."""
    rows = [
        *(("orders", name, "time") for name in TIME_DIMENSIONS),
        *(("orders", name, "categorical") for name in ORDER_DIMENSIONS),
        *(("customers", name, "categorical") for name in CUSTOMER_DIMENSIONS),
    ]
    return spark.createDataFrame(rows, "model string, dimension string, type string")
