"""Raw tables derived from the given star-schema test tables.

Those tables have no payments, reviews, nulls, status set or times of day, so these adapters add
them by rules on the keys. Names and values are those of FIXTURES.md, section 2.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from orderlake.sources.schemas import RAW_TABLES

# Schemas of the given files. Stated, so that no job is spent on reading footers for them.
FILE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
}

# Order states by order key modulo 8, used where the order is not finished.
OPEN_STATES = (
    "shipped", "canceled", "invoiced", "processing",
    "unavailable", "created", "approved", "delivered",
)

# Payment types by part key modulo 9; the rest pay by credit card.
PAYMENT_TYPES = {5: "not_defined", 6: "boleto", 7: "voucher", 8: "debit_card"}

# State code by nation key. XX belongs to no region.
NATION_STATES = (
    "SP", "RJ", "MG", "ES", "PR", "SC", "RS", "GO", "MT", "MS", "DF", "BA", "PE",
    "CE", "MA", "PB", "RN", "AL", "SE", "PI", "AM", "PA", "RO", "AC", "XX",
)

# Translated categories. ECONOMY is left out, so it keeps its own name.
TRANSLATIONS = (
    ("MEDIUM", "medium_goods"),
    ("STANDARD", "standard_goods"),
    ("LARGE", "large_goods"),
    ("PROMO", "promo_goods"),
    ("SMALL", "small_goods"),
)


def listed(values) -> str:
    """A short fixed list as a SQL array."""
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def money_from_cents(cents: str) -> str:
    """Money from cents, rounded down, without the slow way from double to decimal."""
    return f"cast(cast(floor({cents}) as decimal(12,0)) * 0.01BD as decimal(10,2))"


ITEM_COLUMNS = (
    "cast(l_orderkey as string) as order_id",
    "cast(l_partkey as string) as product_id",
    "cast(l_suppkey as string) as seller_id",
    "l_shipdate as shipping_limit_date",
    f"{money_from_cents('l_extendedprice')} as price",
    f"{money_from_cents('l_extendedprice * l_discount')} as freight_value",
)

# A line's place in its order, since (l_orderkey, l_linenumber) repeats in the files: line number, part
# and supplier written one after the other, each with as many digits as the next, so that text sorts as
# the numbers do. It comes from the row alone, so no row meets another, and takes whole numbers of 64
# bits only. Lines that are alike in all three share it.
LINE_SEQUENCE = """concat(
    cast((1000000L + l_linenumber) * 1000000000000L + l_partkey as string),
    cast(1000000000000L + l_suppkey as string))"""


def read_file(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


class DriverTables(Mapping):
    """The nine raw tables over one folder of test files, each made on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._made: dict[str, DataFrame] = {}

    def __iter__(self) -> Iterator[str]:
        return iter(RAW_TABLES)

    def __len__(self) -> int:
        return len(RAW_TABLES)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in RAW_TABLES:
            raise KeyError(name)
        if name not in self._made:
            self._made[name] = getattr(self, f"_{name}")()
        return self._made[name]

    def file(self, name: str) -> DataFrame:
        """One given file as it is."""
        return read_file(self.spark, self.folder, name)

    def _orders(self) -> DataFrame:
        open_state = f"element_at({listed(OPEN_STATES)}, cast(o_orderkey % 8 + 1 as int))"
        dated = self.file("orders").selectExpr(
            "o_orderkey",
            "o_custkey",
            "o_orderdate",
            f"if(o_orderstatus = 'F', 'delivered', {open_state}) as status",
            "o_orderdate + (o_orderkey * 37) % 86400 * interval 1 second as purchased",
        )
        return dated.selectExpr(
            "cast(o_orderkey as string) as order_id",
            "cast(o_custkey as string) as customer_id",
            "status as order_status",
            "purchased as order_purchase_timestamp",
            "if(status <> 'created', purchased + interval 1 hour, null) as order_approved_at",
            "if(status in ('shipped', 'delivered'), purchased + interval 2 day, null) as order_delivered_carrier_date",
            """if(status = 'delivered', purchased + (2 + o_orderkey % 40) * interval 1 day
                + (o_orderkey * 53) % 86400 * interval 1 second, null) as order_delivered_customer_date""",
            "o_orderdate + (10 + o_custkey % 30) * interval 1 day as order_estimated_delivery_date",
        )

    def _order_items(self) -> DataFrame:
        return self.file("lineitem").selectExpr(f"{LINE_SEQUENCE} as order_item_id", *ITEM_COLUMNS)

    def _order_payments(self) -> DataFrame:
        types = " ".join(f"when {part} then '{name}'" for part, name in PAYMENT_TYPES.items())
        uplift = "case when l_orderkey % 50 = 0 then 1.6D when l_partkey % 9 < 5 then 1D + l_tax else 1D end"
        paid = f"(floor(l_extendedprice) / 100 + floor(l_extendedprice * l_discount) / 100) * {uplift}"
        return self.file("lineitem").selectExpr(
            "cast(l_orderkey as string) as order_id",
            f"{LINE_SEQUENCE} as payment_sequential",
            f"case l_partkey % 9 {types} else 'credit_card' end as payment_type",
            "2 * l_linenumber - 1 as payment_installments",
            f"{money_from_cents(f'{paid} * 100')} as payment_value",
        )

    def _order_reviews(self) -> DataFrame:
        """One review for each line with the number 1; the test tables have none of their own."""
        return self.file("lineitem").filter("l_linenumber = 1").selectExpr(
            f"concat_ws('-', l_orderkey, {LINE_SEQUENCE}) as review_id",
            "cast(l_orderkey as string) as order_id",
            "cast(1 + l_partkey % 5 as int) as review_score",
        )

    def _placed(self, name: str, nation: str) -> DataFrame:
        """Rows of a file with the city and state of their nation; Spark broadcasts the 25 nations."""
        places = self.file("nation").selectExpr(
            f"n_nationkey as {nation}",
            "n_name as city",
            f"element_at({listed(NATION_STATES)}, n_nationkey + 1) as state",
        )
        return self.file(name).join(places, nation)

    def _customers(self) -> DataFrame:
        return self._placed("customer", "c_nationkey").selectExpr(
            "cast(c_custkey as string) as customer_id",
            "cast(c_custkey - c_custkey % 2 as string) as customer_unique_id",
            "cast(10000 + c_custkey % 9000 as string) as customer_zip_code_prefix",
            "city as customer_city",
            "state as customer_state",
        )

    def _sellers(self) -> DataFrame:
        return self._placed("supplier", "s_nationkey").selectExpr(
            "cast(s_suppkey as string) as seller_id",
            "cast(10000 + s_suppkey % 9000 as string) as seller_zip_code_prefix",
            "city as seller_city",
            "state as seller_state",
        )

    def _products(self) -> DataFrame:
        return self.file("part").selectExpr(
            "cast(p_partkey as string) as product_id",
            "if(p_size % 10 <> 0, p_type, null) as product_category_name",
            "cast(length(p_name) as bigint) as product_name_lenght",
            "cast(p_size * 10 as bigint) as product_description_lenght",
            "cast(p_size as bigint) as product_photos_qty",
            "if(p_partkey % 97 <> 0, p_size * 400, null) as product_weight_g",
            "p_size as product_length_cm",
            "if(p_partkey % 89 <> 0, p_size + 1, null) as product_height_cm",
            "p_size + 2 as product_width_cm",
        )

    def _product_category_name_translation(self) -> DataFrame:
        return self.spark.createDataFrame(
            TRANSLATIONS, "product_category_name string, product_category_name_english string"
        )

    def _geolocation(self) -> DataFrame:
        return self["customers"].selectExpr(
            "customer_zip_code_prefix as geolocation_zip_code_prefix",
            "-1.0D * (cast(customer_id as bigint) % 30) as geolocation_lat",
            "-35.0D - (cast(customer_id as bigint) % 38) as geolocation_lng",
            "customer_city as geolocation_city",
            "customer_state as geolocation_state",
        )
