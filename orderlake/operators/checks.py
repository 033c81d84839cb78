"""Data-quality checks. Each operator returns what breaks its rule; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, replace
from decimal import Decimal
from functools import reduce
from itertools import pairwise
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, FractionalType, IntegralType

from orderlake.functions import bits
from orderlake.functions.buckets import INSTALLMENT_BUCKETS, INSTALLMENT_MISSING
from orderlake.functions.buckets import REGION_MISSING, REGIONS, WEIGHT_BUCKETS, WEIGHT_MISSING
from orderlake.functions.numbers import round_half_away
from orderlake.operators.staging import UNCHANGED

# What the checked columns may hold.
ORDER_STATUSES = (
    "delivered", "shipped", "canceled", "invoiced", "processing", "unavailable", "created", "approved",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
REVIEW_SCORES = (1, 2, 3, 4, 5)

# How far payments of an order may stray from its revenue, by dominant payment type:
# an amount, or a share of the revenue if that is more.
TOLERANCES = {
    "credit_card": (Decimal("100.00"), Decimal("0.35")),
    "debit_card": (Decimal("20.00"), Decimal("0.05")),
    "voucher": (Decimal("20.00"), Decimal("0.10")),
}
OTHER_TOLERANCE = Decimal("5.00")


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values found more than once, with their number of rows. A null is not a value.

    In two passes: first the rows are counted by a hash of 8 bytes, then only rows whose hash may be
    one of those counted twice are grouped by their values. The filter between them has a fixed size
    and lets no repeated value pass by, so the result is exact, and keys that do not repeat are not
    shuffled.
    """
    known = df.dropna(subset=list(columns))
    key = F.xxhash64(*columns)
    twice = known.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    suspects = known.filter(bits.may_hold(bits.words(twice, "key").scalar(), key))
    return suspects.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows in which the column is null."""
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Values outside the list, with their number of rows. Null is accepted."""
    return df.filter(~F.col(column).isin(*values)).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def as_number(df: DataFrame, column: str) -> Column | None:
    """Days and whole numbers as 64-bit numbers; None for a column of another type."""
    kind = df.schema[column].dataType
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("bigint")
    return F.col(column).cast("bigint") if isinstance(kind, IntegralType) else None


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child values that the parent does not have, with their number of rows. Null refers to nothing.

    Both sides are reduced to one row per value before the join, so no value is too frequent for it;
    the join then uses the partitioning that this took. Whole numbers and days are looked up before
    that in an exact filter of the parent's values, so that only violations, and values too far from
    the parent's least one for the filter, are shuffled.
    """
    references = child.filter(F.col(column).isNotNull())
    number, known = as_number(child, column), as_number(parent, field)
    if number is not None and known is not None and child.schema[column].dataType == parent.schema[field].dataType:
        numbers = parent.select(known.alias("number"))
        least = numbers.agg(F.min("number")).scalar()
        references = references.filter(~bits.holds(bits.exact_words(numbers, "number", least).scalar(), number, least))
    references = references.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    known = parent.select(F.col(field).alias(column)).distinct()
    return references.join(known, column, "left_anti")


def negative_revenue() -> Column:
    return F.col("gross_revenue") < 0


def assert_no_negative_revenue(orders: DataFrame) -> DataFrame:
    return orders.filter(negative_revenue()).select("order_id", "gross_revenue")


def unreconciled() -> Column:
    """Orders, not canceled, whose payments stray from the revenue by more than the tolerance."""
    revenue, paid = F.col("gross_revenue"), F.col("total_payment_amount")
    allowed = F.lit(OTHER_TOLERANCE)
    for payment_type, (amount, share) in TOLERANCES.items():
        larger = F.greatest(F.lit(amount), revenue * F.lit(share))
        allowed = F.when(F.col("primary_payment_type") == payment_type, larger).otherwise(allowed)
    return ~F.col("is_canceled") & (F.abs(revenue - paid) > allowed)


def assert_order_revenue_matches_payments(orders: DataFrame) -> DataFrame:
    """Unreconciled orders with the gap, and the uplift in percent where there is revenue."""
    revenue, paid = F.col("gross_revenue"), F.col("total_payment_amount")
    percent = (F.lit(100) * (paid - revenue)).cast("double") / revenue.cast("double")
    return orders.filter(unreconciled()).select(
        "order_id",
        "primary_payment_type",
        "max_installments",
        "gross_revenue",
        "total_payment_amount",
        F.abs(revenue - paid).alias("discrepancy"),
        F.when(revenue > 0, round_half_away(percent, 2)).alias("uplift_pct"),
    )


class Joined(NamedTuple):
    """A fact that is an inner join of lines with a table, and of that with further ones: each step's key and rows.

    A step has the key of the next one, by which its rows are found there, and under the fact's names the columns that
    the fact takes from it. The lines are the first step, without a key. `fact` is the operator: of all lines or some.
    """

    steps: list[tuple[str, DataFrame]]
    fact: Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Check:
    """One rule on one table. `error` fails the build, `warn` only reports."""

    table: str
    kind: str
    column: str
    values: tuple = ()
    parent: str = ""
    field: str = ""
    severity: str = "error"

    @property
    def name(self) -> str:
        if self.kind in ASSERTIONS:
            return self.kind
        return f"{self.kind}:{self.table}.{self.column}"


# Rules on whole rows, by check kind.
ASSERTIONS = {
    "assert_no_negative_revenue": negative_revenue,
    "assert_order_revenue_matches_payments": unreconciled,
}


# Columns that such rules read.
ASSERTED = {
    "assert_no_negative_revenue": ("gross_revenue",),
    "assert_order_revenue_matches_payments": ("gross_revenue", "total_payment_amount", "primary_payment_type", "is_canceled"),
}


def keyed(table: str, *columns: str) -> list[Check]:
    """Each column is a key: without nulls, without repeats."""
    return [Check(table, kind, column) for column in columns for kind in ("unique", "not_null")]


def filled(table: str, *columns: str) -> list[Check]:
    return [Check(table, "not_null", column) for column in columns]


def one_of(table: str, column: str, values: Iterable) -> list[Check]:
    return [Check(table, "accepted_values", column, values=tuple(values))]


def refers(table: str, column: str, parent: str, field: str | None = None) -> list[Check]:
    return [Check(table, "relationships", column, parent=parent, field=field or column)]


# The 84 rules. `orders` and the like are raw tables.
CHECKS: tuple[Check, ...] = (
    *keyed("orders", "order_id"),
    *filled("orders", "customer_id", "order_purchase_timestamp"),
    *refers("orders", "customer_id", "customers"),
    *one_of("orders", "order_status", ORDER_STATUSES),
    *filled("order_items", "order_id", "order_item_id", "product_id", "seller_id"),
    *refers("order_items", "order_id", "orders"),
    *refers("order_items", "product_id", "products"),
    *refers("order_items", "seller_id", "sellers"),
    *keyed("customers", "customer_id"),
    *filled("customers", "customer_unique_id"),
    *keyed("products", "product_id"),
    *keyed("sellers", "seller_id"),
    *filled("order_payments", "order_id"),
    *refers("order_payments", "order_id", "orders"),
    *one_of("order_payments", "payment_type", PAYMENT_TYPES),
    *filled("order_reviews", "order_id"),
    *refers("order_reviews", "order_id", "orders"),
    *one_of("order_reviews", "review_score", REVIEW_SCORES),
    *keyed("product_category_name_translation", "product_category_name"),
    *filled("product_category_name_translation", "product_category_name_english"),
    *keyed("stg_orders", "order_id"),
    *filled("stg_orders", "customer_id"),
    *one_of("stg_orders", "order_status", ORDER_STATUSES),
    *filled("stg_order_items", "order_id", "item_sequence"),
    *keyed("stg_customers", "customer_id"),
    *filled("stg_customers", "customer_unique_id"),
    *keyed("stg_products", "product_id"),
    *filled("stg_products", "category_name"),
    *keyed("stg_sellers", "seller_id"),
    *filled("stg_payments", "order_id"),
    *keyed("dim_dates", "date_key"),
    *filled("dim_dates", "year", "month"),
    *keyed("dim_customers", "customer_key", "customer_unique_id"),
    *filled("dim_customers", "state"),
    *keyed("dim_products", "product_key", "product_id"),
    *filled("dim_products", "category_name"),
    *one_of("dim_products", "weight_bucket", [*(label for _, label in WEIGHT_BUCKETS), WEIGHT_MISSING]),
    *keyed("dim_sellers", "seller_key", "seller_id"),
    *one_of("dim_sellers", "region", [*REGIONS, REGION_MISSING]),
    *keyed("fct_orders", "order_key", "order_id"),
    *refers("fct_orders", "customer_key", "dim_customers"),
    *refers("fct_orders", "order_date_key", "dim_dates", "date_key"),
    *one_of("fct_orders", "order_status", ORDER_STATUSES),
    *keyed("fct_order_items", "order_item_key"),
    *refers("fct_order_items", "customer_key", "dim_customers"),
    *refers("fct_order_items", "product_key", "dim_products"),
    *refers("fct_order_items", "seller_key", "dim_sellers"),
    *keyed("fct_payments", "payment_key"),
    *one_of("fct_payments", "payment_type", PAYMENT_TYPES),
    *one_of(
        "fct_payments", "installment_bucket", [*(label for _, label in INSTALLMENT_BUCKETS), INSTALLMENT_MISSING]
    ),
    *keyed("time_spine", "date_day"),
    Check("fct_orders", "assert_no_negative_revenue", "gross_revenue"),
    Check("fct_orders", "assert_order_revenue_matches_payments", "total_payment_amount", severity="warn"),
)


def run_check(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The violations of one rule, as its operator returns them."""
    df = tables[check.table]
    if check.kind == "unique":
        return unique(df, check.column)
    if check.kind == "not_null":
        return not_null(df, check.column)
    if check.kind == "accepted_values":
        return accepted_values(df, check.column, check.values)
    if check.kind == "relationships":
        return relationships(df, check.column, tables[check.parent], check.field)
    if check.kind == "assert_no_negative_revenue":
        return assert_no_negative_revenue(df)
    if check.kind == "assert_order_revenue_matches_payments":
        return assert_order_revenue_matches_payments(df)
    raise ValueError(f"unknown kind of check {check.kind!r}")


def breaks(check: Check) -> Column:
    """Whether a row breaks a rule that needs no other row to tell."""
    column = F.col(check.column)
    if check.kind == "accepted_values":
        return ~column.isin(*check.values)
    return column.isNull() if check.kind == "not_null" else ASSERTIONS[check.kind]()


def value_text(column: Column, kind: DataType) -> Column:
    """Text that is equal where values are, as values of the given type."""
    if isinstance(kind, FractionalType) and not isinstance(kind, DecimalType):
        column = column + F.lit(0)  # no negative zero
    return column.cast(kind).cast("string")


def compared_as(check: Check, tables: Mapping[str, DataFrame]) -> DataType:
    """The type that a column's values are compared as: with a parent, the wider of both."""
    own = tables[check.table].select(check.column)
    if check.kind == "relationships":
        own = own.union(tables[check.parent].select(check.field))
    return own.schema[0].dataType


def rows_of(checks: Mapping[int, Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """What the checks of one table read. Orders come without the joins and counts that no check asks for, lines without
    those that break no rule, where tables can leave them out."""
    name = next(iter(checks.values())).table
    if name == "fct_orders" and hasattr(tables, "order_facts"):
        return tables.order_facts([column for c in checks.values() for column in ASSERTED.get(c.kind, (c.column,))])
    parts = tables.joined(name) if hasattr(tables, "joined") else None
    return tables[name] if parts is None else suspects(checks, tables, parts)


VALUE_KINDS = ("unique", "accepted_values", "relationships")

# What is kept of a table besides its checks: how many rows it has.
ROWS = "rows"


def counters(table: str, checks: Iterable[Check] = CHECKS) -> list[Column]:
    """How many rows of a table there are, and how many break each rule that needs no other row to tell.

    Observed while the table is written, they spare the check a scan of its own.
    """
    of_table = [c for c in checks if c.table == table and c.kind not in ("unique", "relationships")]
    return [F.count(F.lit(1)).alias(ROWS), *(F.count(F.when(breaks(c), 1)).alias(c.name) for c in of_table)]


def told_by_facts(check: Check, facts: Mapping[str, Mapping[str, int]]) -> int | None:
    """A check's violations where counters tell them.

    A rule on values counts values, not rows, so that its counter tells only that there are none.
    """
    rows = facts.get(check.table, {}).get(check.name)
    return rows if check.kind != "accepted_values" or not rows else None


def runs_as(check: Check) -> Check:
    """The check that gives the same result: the one on the raw column that a staging column is."""
    raw, columns = UNCHANGED.get(check.table, ("", {}))
    return replace(check, table=raw, column=columns[check.column]) if check.column in columns else check


def compact(text: Column) -> Column:
    """Bytes that are equal where texts are: 16 for a digest, which are half its digits; else the text's own, one more
    from a length of 16."""
    own, size = F.encode(text, "UTF-8"), F.octet_length(text)
    digest = F.when((size == 32) & (F.lower(text) == text), F.unhex(text))
    return F.when(size < 16, own).otherwise(F.coalesce(digest, F.concat(own, F.lit(b"\0"))))


def in_full(value: Column) -> Column:
    """The text that `compact` made these bytes of."""
    size = F.octet_length(value)
    own = F.when(size < 16, value).otherwise(value.substr(F.lit(1), size - 1))
    return F.when(size == 16, F.lower(F.hex(value))).otherwise(F.decode(own, "UTF-8"))


def kinds_of(checks: Mapping[int, Check], tables: Mapping[str, DataFrame]) -> dict[int, DataType]:
    return {n: compared_as(c, tables) for n, c in checks.items() if c.kind in VALUE_KINDS}


def found_in(table: DataFrame, checks: Mapping[int, Check], tables: Mapping[str, DataFrame], hashed: bool) -> DataFrame:
    """(number, key, value, row_count): what breaks the checks, from one scan of a table that has their columns.

    A row adds its values to the checks that compare values, and to the others only what breaks them,
    so those send one row per task. Findings are counted per check and value on both sides of one
    shuffle, so no value is too frequent. The parent's values go through the same shuffle as no rows;
    references to what is there drop out.
    """
    kinds = kinds_of(checks, tables)

    def finding(n: int, c: Check) -> Column:
        column = F.col(c.column)
        says = column.isNotNull() if c.kind in ("unique", "relationships") else breaks(c)
        by_hash = hashed and c.kind == "unique"
        key = F.xxhash64(value_text(column, kinds[n])) if by_hash else F.lit(0).cast("bigint")
        value = compact(value_text(column, kinds[n])) if n in kinds and not by_hash else F.lit(None).cast("binary")
        return F.when(says, F.struct(F.lit(n).alias("number"), key.alias("key"), value.alias("value")))

    found = table.select(F.explode(F.array(*(finding(n, c) for n, c in checks.items()))).alias("finding"))
    rows = found.filter(F.col("finding").isNotNull()).select("finding.*", F.lit(1).alias("rows"))
    for n, c in checks.items():
        if c.kind == "relationships":
            value = compact(value_text(F.col(c.field), kinds[n]))
            known = (F.lit(n).alias("number"), F.lit(0).cast("bigint").alias("key"), value.alias("value"))
            rows = rows.unionByName(tables[c.parent].select(*known, F.lit(0).alias("rows")))
    counted = rows.groupBy("number", "key", "value").agg(F.sum("rows").alias("row_count"), F.min("rows").alias("least"))
    keys = [n for n, c in checks.items() if c.kind == "unique"]
    return counted.filter(((F.col("row_count") > 1) | ~F.col("number").isin(keys)) & (F.col("least") > 0)).drop("least")


def that_may_break(
    rows: DataFrame, checks: Mapping[int, Check], tables: Mapping[str, DataFrame], wrong: Mapping[str, Column]
) -> DataFrame:
    """Without rows that break none of the checks, of which keys are compared with the others of the table.

    `wrong` has by column the filter of hashes that another table finds wrong; rows that refer to them stay. The filters
    are asked for hashes that stand in columns of their own, since a condition would compute them anew at each mention.
    """
    compared = {n: c for n, c in checks.items() if c.kind in ("unique", "relationships")}
    broken = [F.coalesce(breaks(c), F.lit(False)) for n, c in checks.items() if n not in compared]
    asked = [(F.xxhash64(column), held) for column, held in wrong.items()]
    if compared:
        kinds, value = kinds_of(compared, tables), F.col("value")
        hashed = F.when(value.isNull(), F.col("key")).otherwise(F.xxhash64(in_full(value)))
        found = found_in(rows, compared, tables, hashed=True).select(F.xxhash64("number", hashed).alias("mark"))
        held = bits.words(found, "mark").scalar()
        texts = {n: value_text(F.col(c.column), kinds[n]) for n, c in compared.items()}
        asked += [(F.xxhash64(F.lit(n), F.xxhash64(text)), held) for n, text in texts.items()]
    if asked:
        marks = [f"mark {i}" for i in range(len(asked))]
        row = F.struct(*(mark.alias(name) for name, (mark, _) in zip(marks, asked, strict=True)))
        rows = rows.select("*", F.inline(F.array(row)))
        broken += [bits.may_hold(held, F.col(name)) for name, (_, held) in zip(marks, asked, strict=True)]
        return rows.filter(reduce(Column.__or__, broken)).drop(*marks)
    return rows.filter(reduce(Column.__or__, broken, F.lit(False)))


def suspects(checks: Mapping[int, Check], tables: Mapping[str, DataFrame], parts: Joined) -> DataFrame:
    """Of a fact that joins lines with one table after the other, the rows that may break a rule: all that do are among them.

    Every row of every table is looked at, but by itself: lines whose key's hash repeats among the lines; rows whose value
    the parent lacks or whose own columns break a rule; rows whose hash repeats of a table joined by it, since a line is
    repeated with them; and what leads to one of these. The filters let none of them by, so the join of such lines gives
    the same violations as the whole one, without moving lines that break nothing. A rule on keys of a table joined, or
    on several columns, needs the whole join, as do keys of types that are not hashed as they are compared.
    """
    steps = parts.steps
    found_at = {n: next((i for i, (_, rows) in enumerate(steps) if c.column in rows.columns), None) for n, c in checks.items()}
    types = [(rows.schema[key].dataType, before.schema[key].dataType) for (_, before), (key, rows) in pairwise(steps)]
    if any(one != other or isinstance(one, FractionalType) for one, other in types) or any(
        c.kind in ASSERTIONS or found_at[n] is None or (c.kind == "unique" and found_at[n]) for n, c in checks.items()
    ):
        return tables[next(iter(checks.values())).table]
    wrong: dict[str, Column] = {}
    for i, (key, rows) in reversed([*enumerate(steps)]):
        of_step = {n: c for n, c in checks.items() if found_at[n] == i}
        breaking = that_may_break(rows, of_step, tables, wrong)
        if key:
            mark = F.xxhash64(key).alias("mark")
            repeated = rows.groupBy(mark).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("mark")
            wrong = {key: bits.words(repeated.unionByName(breaking.select(mark)), "mark").scalar()}
    return parts.fact(breaking)


def table_violations(checks: Mapping[int, Check], tables: Mapping[str, DataFrame], hashed: bool = False) -> DataFrame:
    """(number, violations) for all checks of one table, to be summed by number.

    A violation is a repeated value, a value outside the list, or a row. With `hashed`, keys are compared by 64-bit
    hashes: no violation then is none, some may be none.
    """
    found = found_in(rows_of(checks, tables), checks, tables, hashed)
    by_value = [n for n, c in checks.items() if c.kind in ("unique", "accepted_values")]
    violations = F.when(F.col("number").isin(by_value), F.lit(1)).otherwise(F.col("row_count"))
    return found.select("number", violations.alias("violations"))


REPORT = "check string, kind string, table_name string, column_name string, severity string"


def as_they_run(checks: Iterable[Check], facts: Mapping[str, Mapping[str, int]]) -> tuple[dict[Check, int], dict[int, Check], dict[int, int]]:
    """By check the number that it runs under; by number the check to run, or the violations that facts tell."""
    numbers: dict[Check, int] = {}
    numbered = {c: numbers.setdefault(runs_as(c), len(numbers)) for c in checks}
    told = {n: told_by_facts(c, facts) for c, n in numbers.items()}
    return numbered, {n: c for c, n in numbers.items() if told[n] is None}, {n: v for n, v in told.items() if v is not None}


def all_violations(checks: Mapping[int, Check], tables: Mapping[str, DataFrame], hashed: bool = False) -> list[DataFrame]:
    """(number, violations) of the checks of each table."""
    names = dict.fromkeys(c.table for c in checks.values())
    return [table_violations({n: c for n, c in checks.items() if c.table == name}, tables, hashed) for name in names]


def check_report(spark: SparkSession, tables: Mapping[str, DataFrame], checks: Iterable[Check] = CHECKS) -> DataFrame:
    """One row per check with its violations and status: pass, warn or error.

    Lazy tables are computed anew for each scan; stored ones are checked faster by `stored_report`.
    Checks of staging columns that are raw columns are taken from these; checks that come to the same
    run once.
    """
    checks = list(checks)
    numbers, numbered, _ = as_they_run(checks, {})
    parts = all_violations(numbered, tables)
    violations = reduce(DataFrame.unionByName, parts).groupBy("number").agg(F.sum("violations").alias("violations"))
    rows = [(numbers[c], c.name, c.kind, c.table, c.column, c.severity) for c in checks]
    declared = spark.createDataFrame(rows, f"number int, {REPORT}")
    return with_status(declared.join(violations, "number", "left").drop("number"))


def with_status(report: DataFrame) -> DataFrame:
    count = F.coalesce(F.col("violations"), F.lit(0)).cast("bigint")
    columns = [c for c in report.columns if c != "violations"]
    return report.select(*columns, count.alias("violations"), F.when(count == 0, "pass").otherwise(F.col("severity")).alias("status"))


def row_count_checks(facts: Mapping[str, Mapping[str, int]], tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    """(number, violations): for the nth table of the facts, -1 - n and its number of rows. Footers tell it."""
    count = F.count(F.lit(1)).alias("violations")
    return [tables[name].agg(count).select(F.lit(-1 - n).alias("number"), "violations") for n, name in enumerate(facts)]


def stored_report(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    checks: Iterable[Check] = CHECKS,
    facts: Mapping[str, Mapping[str, int]] | None = None,
) -> DataFrame:
    """The report over stored tables, computed at once: counters as they are, keys by hashes first.

    `facts` holds what `counters` counted of a table; they hold if the table still has as many rows.
    Only a key column in which hashes repeat is compared by values. The result has a row per check.
    """
    checks, facts = list(checks), dict(facts or {})
    numbers, numbered, told = as_they_run(checks, facts)
    parts = [*all_violations(numbered, tables, hashed=True), *row_count_checks(facts, tables)]
    sums = reduce(DataFrame.unionByName, parts).groupBy("number").agg(F.sum("violations").alias("violations"))
    found = told | {r.number: r.violations for r in sums.collect()}
    wrong = {name for n, name in enumerate(facts) if found.get(-1 - n, 0) != facts[name].get(ROWS)}

    again = [c for c in checks if runs_as(c).table in wrong or (c.kind == "unique" and found.get(numbers[c]))]
    exact = {r.check: r.violations for r in check_report(spark, tables, again).collect()} if again else {}
    rows = [
        (c.name, c.kind, c.table, c.column, c.severity, exact.get(c.name, found.get(numbers[c], 0))) for c in checks
    ]
    return with_status(spark.createDataFrame(rows, f"{REPORT}, violations bigint"))


def status_counts(report: DataFrame) -> DataFrame:
    """(status, checks): how many checks passed, warned and failed."""
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("checks"))
