"""The registered queries once more, as SQL for DuckDB over the given tables.

Written apart from the Spark code, and in other terms where there is a choice, so that an agreement
of the two says something. Every statement is put together from the common table expressions that
it needs.
"""

from __future__ import annotations

from orderlake.operators.checks import CHECKS, Check
from orderlake.operators.metrics import METRICS

# State code by nation key, order state by order key modulo 8.
STATES = """(values (0, 'SP'), (1, 'RJ'), (2, 'MG'), (3, 'ES'), (4, 'PR'), (5, 'SC'), (6, 'RS'), (7, 'GO'), (8, 'MT'),
  (9, 'MS'), (10, 'DF'), (11, 'BA'), (12, 'PE'), (13, 'CE'), (14, 'MA'), (15, 'PB'), (16, 'RN'), (17, 'AL'),
  (18, 'SE'), (19, 'PI'), (20, 'AM'), (21, 'PA'), (22, 'RO'), (23, 'AC'), (24, 'XX')) states(nation, state)"""
OPEN_STATES = """(values (0, 'shipped'), (1, 'canceled'), (2, 'invoiced'), (3, 'processing'), (4, 'unavailable'),
  (5, 'created'), (6, 'approved'), (7, 'delivered')) open_states(remainder, open_state)"""
MONEY = "decimal(10,2)"
TOTAL = "decimal(38,2)"


def key(*parts: str) -> str:
    texts = [f"coalesce(cast({p} as varchar), '_dbt_utils_surrogate_key_null_')" for p in parts]
    return f"md5({' || chr(45) || '.join(texts)})"


# name -> (names it reads, SQL). Raw tables first: rules of FIXTURES.md, section 2.
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_orders": (
        (),
        f"""
        select cast(o_orderkey as varchar) order_id, cast(o_custkey as varchar) customer_id,
          status order_status, purchased order_purchase_timestamp,
          case when status <> 'created' then purchased + interval 1 hour end order_approved_at,
          case when status in ('shipped', 'delivered') then purchased + interval 2 day end
            order_delivered_carrier_date,
          case when status = 'delivered' then purchased + (2 + o_orderkey % 40) * interval 1 day
            + ((o_orderkey * 53) % 86400) * interval 1 second end order_delivered_customer_date,
          o_orderdate + (10 + o_custkey % 30) * interval 1 day order_estimated_delivery_date
        from (select *, o_orderdate + ((o_orderkey * 37) % 86400) * interval 1 second as purchased,
            case when o_orderstatus = 'F' then 'delivered' else open_state end status
          from orders join {OPEN_STATES} on remainder = o_orderkey % 8) q""",
    ),
    "raw_order_items": (
        (),
        """
        select cast(l_orderkey as varchar) order_id,
          '1' || lpad(cast(l_linenumber as varchar), 6, '0') || lpad(cast(l_partkey as varchar), 12, '0')
            || '1' || lpad(cast(l_suppkey as varchar), 12, '0') order_item_id,
          cast(l_partkey as varchar) product_id, cast(l_suppkey as varchar) seller_id,
          l_shipdate shipping_limit_date, floor(l_extendedprice) / 100 price,
          floor(l_extendedprice * l_discount) / 100 freight_value,
          l_orderkey, l_linenumber, l_partkey, l_tax
        from lineitem""",
    ),
    "raw_order_payments": (
        ("raw_order_items",),
        """
        select order_id, order_item_id payment_sequential,
          case l_partkey % 9 when 6 then 'boleto' when 7 then 'voucher' when 8 then 'debit_card'
            when 5 then 'not_defined' else 'credit_card' end payment_type,
          2 * l_linenumber - 1 payment_installments,
          floor((price + freight_value) * (case when l_orderkey % 50 = 0 then 1.6::double
            when l_partkey % 9 < 5 then 1 + l_tax else 1 end) * 100) / 100 payment_value
        from raw_order_items""",
    ),
    "raw_order_reviews": (
        ("raw_order_items",),
        """
        select order_id || '-' || order_item_id review_id, order_id,
          1 + l_partkey % 5 review_score
        from raw_order_items where l_linenumber = 1""",
    ),
    "raw_customers": (
        (),
        f"""
        select cast(c_custkey as varchar) customer_id,
          cast(c_custkey - c_custkey % 2 as varchar) customer_unique_id,
          cast(10000 + c_custkey % 9000 as varchar) customer_zip_code_prefix, n_name customer_city,
          state customer_state
        from customer join nation on c_nationkey = n_nationkey join {STATES} on c_nationkey = nation""",
    ),
    "raw_sellers": (
        (),
        f"""
        select cast(s_suppkey as varchar) seller_id,
          cast(10000 + s_suppkey % 9000 as varchar) seller_zip_code_prefix, n_name seller_city,
          state seller_state
        from supplier join nation on s_nationkey = n_nationkey join {STATES} on s_nationkey = nation""",
    ),
    "raw_products": (
        (),
        """
        select cast(p_partkey as varchar) product_id,
          case when p_size % 10 <> 0 then p_type end product_category_name,
          length(p_name) product_name_lenght, p_size * 10 product_description_lenght,
          p_size product_photos_qty, case when p_partkey % 97 <> 0 then p_size * 400 end product_weight_g,
          p_size product_length_cm, case when p_partkey % 89 <> 0 then p_size + 1 end product_height_cm,
          p_size + 2 product_width_cm
        from part""",
    ),
    "raw_translation": (
        (),
        """
        select * from (values ('MEDIUM', 'medium_goods'), ('STANDARD', 'standard_goods'),
          ('LARGE', 'large_goods'), ('PROMO', 'promo_goods'), ('SMALL', 'small_goods'))
          t(product_category_name, product_category_name_english)""",
    ),
    "raw_geolocation": (
        ("raw_customers",),
        """
        select customer_zip_code_prefix geolocation_zip_code_prefix,
          -1.0 * (cast(customer_id as bigint) % 30) geolocation_lat,
          -35.0 - (cast(customer_id as bigint) % 38) geolocation_lng,
          customer_city geolocation_city, customer_state geolocation_state
        from raw_customers""",
    ),
    "stg_customers": (
        ("raw_customers",),
        """
        select customer_id, customer_unique_id, customer_zip_code_prefix zip_code_prefix,
          customer_city city, customer_state state
        from raw_customers""",
    ),
    "stg_orders": (
        ("raw_orders",),
        """
        select *, delivered_at::date - purchased_at::date delivery_days_actual,
          estimated_delivery_at::date - purchased_at::date delivery_days_estimated
        from (
          select order_id, customer_id, order_status, order_purchase_timestamp purchased_at,
            order_approved_at approved_at, order_delivered_carrier_date shipped_at,
            order_delivered_customer_date delivered_at,
            order_estimated_delivery_date estimated_delivery_at,
            order_status is not distinct from 'delivered' is_delivered,
            order_status is not distinct from 'canceled' is_canceled,
            ifnull(order_status in ('shipped', 'processing', 'approved', 'invoiced', 'created'), false)
              is_in_progress,
            if(order_delivered_customer_date is null, null,
              ifnull(order_delivered_customer_date > order_estimated_delivery_date, false))
              is_late_delivery
          from raw_orders)""",
    ),
    "stg_order_items": (
        ("raw_order_items",),
        f"""
        select order_id, order_item_id item_sequence, product_id, seller_id,
          shipping_limit_date shipping_limit_at, price::{MONEY} item_price,
          freight_value::{MONEY} freight_value,
          (price::{MONEY} + freight_value::{MONEY})::decimal(11,2) total_item_revenue
        from raw_order_items""",
    ),
    "stg_payments": (
        ("raw_order_payments",),
        f"""
        select order_id, payment_sequential installment_sequence, payment_type,
          payment_installments::int installment_count, payment_value::{MONEY} payment_amount
        from raw_order_payments""",
    ),
    "stg_products": (
        ("raw_products", "raw_translation"),
        f"""
        select product_id, ifnull(ifnull((select product_category_name_english from raw_translation t
            where t.product_category_name = p.product_category_name), product_category_name), 'unknown')
            category_name,
          product_category_name category_name_pt, product_name_lenght name_length,
          product_description_lenght::bigint description_length, product_photos_qty::bigint photos_qty,
          product_weight_g::{MONEY} weight_g, product_length_cm::{MONEY} length_cm,
          product_height_cm::{MONEY} height_cm, product_width_cm::{MONEY} width_cm
        from raw_products p""",
    ),
    "stg_sellers": (
        ("raw_sellers",),
        """
        select seller_id, seller_zip_code_prefix zip_code_prefix, seller_city city, seller_state state
        from raw_sellers""",
    ),
    "item_rollup": (
        ("stg_order_items",),
        f"""
        select order_id, count(*) item_count, count(distinct product_id) distinct_product_count,
          count(distinct seller_id) distinct_seller_count,
          sum(item_price)::{TOTAL} gross_item_revenue, sum(freight_value)::{TOTAL} total_freight,
          sum(total_item_revenue)::{TOTAL} gross_revenue,
          sum(item_price)::double / count(item_price) avg_item_price,
          max(item_price) max_item_price, min(item_price) min_item_price
        from stg_order_items group by 1""",
    ),
    "first_payment": (
        ("stg_payments",),
        """
        select order_id, payment_type primary_payment_type from stg_payments
        qualify row_number() over (partition by order_id
          order by payment_amount desc nulls last, installment_sequence) = 1""",
    ),
    "payment_rollup": (
        ("stg_payments", "first_payment"),
        f"""
        select p.order_id, sum(payment_amount)::{TOTAL} total_payment_amount,
          count(*) payment_record_count, max(installment_count) max_installments,
          count(distinct payment_type) >= 2 is_multi_payment_method,
          any_value(primary_payment_type) primary_payment_type
        from stg_payments p left join first_payment f on p.order_id = f.order_id group by 1""",
    ),
    "bounds": (
        ("raw_orders",),
        """
        select date_trunc('year', min(order_purchase_timestamp))::date start_date,
          (date_trunc('year', max(order_purchase_timestamp)) + interval 1 year)::date end_date
        from raw_orders""",
    ),
    "dim_dates": (
        ("bounds",),
        """
        select t::date date_key, t full_date, year(t) as year, quarter(t) as quarter, month(t) as month,
          weekofyear(t) iso_week, day(t) day_of_month, isodow(t) % 7 day_of_week,
          dayofyear(t) day_of_year, left(t::date::varchar, 7) year_month, monthname(t) month_name,
          dayname(t) day_name, isodow(t) >= 6 is_weekend,
          (t::date - (isodow(t) - 1)::int) week_start, (t::date - (day(t) - 1)::int) month_start,
          date_trunc('quarter', t)::date quarter_start, make_date(year(t), 1, 1) year_start
        from (select unnest(generate_series(start_date::timestamp, end_date - interval 1 day,
          interval 1 day)) t from bounds)""",
    ),
    "time_spine": (("dim_dates",), "select date_key date_day from dim_dates"),
    "dim_customers": (
        ("stg_customers",),
        f"""
        select {key("customer_unique_id")} customer_key, * from (
          select customer_unique_id, max(zip_code_prefix) zip_code_prefix, max(city) city,
            max(state) state, count(distinct customer_id) order_account_count
          from stg_customers group by 1)""",
    ),
    "dim_products": (
        ("stg_products",),
        f"""
        select {key("product_id")} product_key, product_id, category_name, category_name_pt,
          ifnull(label, 'unknown') weight_bucket, weight_g, length_cm, height_cm, width_cm,
          (length_cm * height_cm * width_cm)::decimal(30,6) volume_cm3, photos_qty, name_length,
          description_length
        from stg_products left join (values (-1e9, 500, 'XS (<0.5kg)'), (500, 2000, 'S (0.5–2kg)'),
            (2000, 5000, 'M (2–5kg)'), (5000, 15000, 'L (5–15kg)'), (15000, 1e9, 'XL (15kg+)'))
            b(low, high, label) on weight_g >= low and weight_g < high""",
    ),
    "dim_sellers": (
        ("stg_sellers",),
        f"""
        select {key("seller_id")} seller_key, seller_id, zip_code_prefix, city, state,
          ifnull(region, 'Unknown') region
        from stg_sellers left join (
          select * from (values
            ('Southeast', 'SP'), ('Southeast', 'RJ'), ('Southeast', 'MG'), ('Southeast', 'ES'),
            ('South', 'PR'), ('South', 'SC'), ('South', 'RS'),
            ('Center-West', 'GO'), ('Center-West', 'MT'), ('Center-West', 'MS'), ('Center-West', 'DF'),
            ('Northeast', 'BA'), ('Northeast', 'PE'), ('Northeast', 'CE'), ('Northeast', 'MA'), ('Northeast', 'PB'),
            ('Northeast', 'RN'), ('Northeast', 'AL'), ('Northeast', 'SE'), ('Northeast', 'PI'),
            ('North', 'AM'), ('North', 'PA'), ('North', 'RO'), ('North', 'AC'), ('North', 'RR'), ('North', 'AP'),
            ('North', 'TO')) r(region, state)) using (state)""",
    ),
    "fct_orders": (
        ("stg_orders", "stg_customers", "dim_customers", "item_rollup", "payment_rollup"),
        f"""
        select {key("o.order_id")} order_key, o.order_id, d.customer_key, c.customer_unique_id,
          o.purchased_at::date order_date_key, order_status, is_delivered, is_canceled, is_in_progress,
          is_late_delivery, purchased_at, approved_at, shipped_at, delivered_at, estimated_delivery_at,
          delivery_days_actual, delivery_days_estimated,
          delivery_days_actual - delivery_days_estimated delivery_days_vs_estimate,
          ifnull(i.item_count, 0) item_count, ifnull(i.distinct_product_count, 0) distinct_product_count,
          ifnull(i.distinct_seller_count, 0) distinct_seller_count, i.gross_item_revenue,
          i.total_freight, i.gross_revenue, i.avg_item_price, p.total_payment_amount,
          p.max_installments, p.primary_payment_type, p.is_multi_payment_method
        from stg_orders o
          left join stg_customers c on c.customer_id = o.customer_id
          left join dim_customers d on d.customer_unique_id = c.customer_unique_id
          left join item_rollup i on i.order_id = o.order_id
          left join payment_rollup p on p.order_id = o.order_id""",
    ),
    "fct_order_items": (
        ("stg_order_items", "stg_orders", "stg_customers"),
        f"""
        select order_id, item_sequence, {key("order_id", "item_sequence")} order_item_key,
          {key("customer_unique_id")} customer_key, {key("product_id")} product_key,
          {key("seller_id")} seller_key, product_id, seller_id, customer_unique_id,
          purchased_at::date order_date_key, delivered_at::date delivery_date_key,
          shipping_limit_at::date shipping_limit_date_key, order_status, is_delivered,
          is_late_delivery, item_price, freight_value, total_item_revenue
        from stg_order_items join stg_orders using (order_id) join stg_customers using (customer_id)""",
    ),
    "fct_payments": (
        ("stg_payments", "stg_orders"),
        f"""
        select order_id, installment_sequence, {key("order_id", "installment_sequence")} payment_key,
          purchased_at::date order_date_key, order_status, payment_type, installment_count,
          payment_amount, ifnull(label, 'unknown') installment_bucket
        from stg_payments join stg_orders using (order_id)
          left join (values (1, 1, '1 (single)'), (2, 3, '2-3'), (4, 6, '4-6'), (7, 12, '7-12'),
            (13, 2147483647, '13+')) b(low, high, label)
            on installment_count >= low and installment_count <= high""",
    ),
    "facts": (
        ("fct_orders", "dim_customers"),
        """
        select f.*, d.state customer_state, d.city customer_city, d.zip_code_prefix customer_zip
        from fct_orders f left join dim_customers d on d.customer_key = f.customer_key""",
    ),
}


def needed(names) -> list[str]:
    """The tables to define for some names, inputs first."""
    order: list[str] = []
    for name in names:
        order += [n for n in [*needed(TABLES[name][0]), name] if n not in order]
    return order


def sql(body: str, *reads: str) -> str:
    """A statement with the definitions of the tables it reads."""
    definitions = ",\n".join(f"{name} as ({TABLES[name][1]})" for name in needed(reads))
    return f"with {definitions}\n{body}" if reads else body


def table(name: str) -> str:
    return sql(f"select * from {name}", name)


REVENUE = f"sum(gross_revenue)::{TOTAL}"
FREIGHT = f"sum(total_freight)::{TOTAL}"
METRIC_SQL = {
    "revenue": REVENUE,
    "item_revenue": f"sum(gross_item_revenue)::{TOTAL}",
    "freight_cost": FREIGHT,
    "order_count": "count(order_id)",
    "items_sold": "sum(item_count)::bigint",
    "unique_customers": "count(distinct customer_unique_id)",
    "canceled_orders": "count(*) filter (where is_canceled)",
    "delivered_orders": "count(*) filter (where is_delivered)",
    "avg_order_value": f"({REVENUE})::double / nullif(count(order_id), 0)",
    "avg_items_per_order": "sum(item_count)::double / nullif(count(order_id), 0)",
    "cancellation_rate": "(count(*) filter (where is_canceled))::double / nullif(count(order_id), 0)",
    "delivery_completion_rate": "(count(*) filter (where is_delivered))::double / nullif(count(order_id), 0)",
    "freight_pct_of_revenue": f"({FREIGHT})::double / nullif(({REVENUE})::double, 0)",
    "revenue_per_customer": f"({REVENUE})::double / nullif(count(distinct customer_unique_id), 0)",
    "net_revenue": f"({REVENUE} - {FREIGHT})::{TOTAL}",
    "cumulative_revenue": REVENUE,
    "payment_sum": f"sum(total_payment_amount)::{TOTAL}",
}

GROUP_SQL = {
    **{f"metric_time__{g}": f"date_trunc('{g}', order_date_key)::date" for g in ("week", "month", "quarter", "year")},
    "metric_time__day": "order_date_key",
    "order_date__month": "date_trunc('month', order_date_key)::date",
    "order__order_status": "order_status",
    "order__is_delivered": "is_delivered",
    "order__is_canceled": "is_canceled",
    "orders__payment_type": "primary_payment_type",
    "order__is_multi_payment_method": "is_multi_payment_method",
    "customer": "customer_key",
    "customer__customer_state": "customer_state",
    "customer__customer_city": "customer_city",
    "customer__customer_zip_prefix": "customer_zip",
}


def metric(metrics: list[str], group_by: list[str]) -> str:
    """A grouped aggregate without running totals; those are written out below."""
    columns = [f'{GROUP_SQL[g]} as "{g}"' for g in group_by] + [f"{METRIC_SQL[m]} as {m}" for m in metrics]
    by = f" group by {', '.join(str(i + 1) for i in range(len(group_by)))}" if group_by else ""
    return sql(f"select {', '.join(columns)} from facts{by}", "facts")


CUMULATIVE_BY_DAY = sql(
    f"""
    select d as metric_time, (select sum(gross_revenue)::{TOTAL} from fct_orders
        where order_date_key <= d) as cumulative_revenue
    from (select date_day d from time_spine where date_day between
      (select min(order_date_key) from fct_orders) and (select max(order_date_key) from fct_orders))""",
    "fct_orders",
    "time_spine",
)

CUMULATIVE_BY_MONTH = sql(
    f"""
    select m as metric_time__month, sum(sum(gross_revenue)) over (order by m)::{TOTAL} cumulative_revenue,
      sum(gross_revenue)::{TOTAL} revenue
    from (select distinct date_trunc('month', date_day)::date m from time_spine) s
      left join fct_orders on date_trunc('month', order_date_key)::date = m
    where m between (select min(date_trunc('month', order_date_key)) from fct_orders)
      and (select max(order_date_key) from fct_orders)
    group by m""",
    "fct_orders",
    "time_spine",
)

CUMULATIVE_BY_QUARTER_AND_STATUS = sql(
    f"""
    select q as metric_time__quarter, s.order_status as order__order_status,
      (select sum(gross_revenue)::{TOTAL} from fct_orders f where f.order_status = s.order_status
        and date_trunc('quarter', order_date_key)::date <= q) as cumulative_revenue
    from (select distinct date_trunc('quarter', date_day)::date q from time_spine)
      join (select order_status, min(order_date_key) first_day from fct_orders group by 1) s
        on q >= date_trunc('quarter', first_day)::date
    where q <= (select max(order_date_key) from fct_orders)""",
    "fct_orders",
    "time_spine",
)


def catalogue() -> str:
    """Names and texts of the metrics, each with its total over all orders."""
    totals = ", ".join(f"({METRIC_SQL[m]})::double as {m}" for m in METRICS)
    texts = ", ".join(
        "(" + ", ".join(f"'{v}'" for v in (n, m.label, m.kind, m.description)) + ")" for n, m in METRICS.items()
    )
    return sql(
        f"""
        select c.name, label, type, description, total
        from (values {texts}) c(name, label, type, description)
          join (unpivot (select {totals} from fct_orders) on columns(*) into name name value total) t
            on t.name = c.name""",
        "fct_orders",
    )


RAW_NAMES = {
    "orders": "raw_orders",
    "order_items": "raw_order_items",
    "customers": "raw_customers",
    "products": "raw_products",
    "sellers": "raw_sellers",
    "order_payments": "raw_order_payments",
    "order_reviews": "raw_order_reviews",
    "geolocation": "raw_geolocation",
    "product_category_name_translation": "raw_translation",
}

RECONCILIATION = """
    select order_id, primary_payment_type, max_installments, gross_revenue, total_payment_amount,
      abs(gross_revenue - total_payment_amount) discrepancy,
      if(gross_revenue > 0, round((100 * (total_payment_amount - gross_revenue))::double
        / gross_revenue::double, 2), null) uplift_pct
    from fct_orders left join (values ('credit_card', 100.00, 0.35), ('debit_card', 20.00, 0.05),
        ('voucher', 20.00, 0.10)) t(payment_type, amount, share) on payment_type = primary_payment_type
    where not is_canceled and abs(total_payment_amount - gross_revenue)
      > if(payment_type is null, 5.00, greatest(amount, gross_revenue * share))"""


def violations_sql(check: Check) -> str:
    """A count of what breaks one rule."""
    source, column = RAW_NAMES.get(check.table, check.table), check.column
    if check.kind == "unique":
        return f"select count(*) from (select 1 from {source} where {column} is not null group by {column} having count(*) > 1)"
    if check.kind == "not_null":
        return f"select count(*) - count({column}) from {source}"
    if check.kind == "accepted_values":
        values = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in check.values)
        return f"select count(distinct {column}) from {source} where {column} not in ({values})"
    if check.kind == "relationships":
        parent = RAW_NAMES.get(check.parent, check.parent)
        return f"select count(*) from {source} c where {column} is not null and not exists (select 1 from {parent} p where p.{check.field} = c.{column})"
    if check.kind == "assert_no_negative_revenue":
        return f"select count(*) from {source} where gross_revenue < 0"
    return f"select count(*) from ({RECONCILIATION})"


def report() -> str:
    rows = " union all ".join(
        f"select '{c.name}' as name, '{c.kind}' kind, '{c.table}' table_name, '{c.column}' column_name, "
        f"'{c.severity}' severity, ({violations_sql(c)}) violations"
        for c in CHECKS
    )
    reads = [RAW_NAMES.get(t, t) for c in CHECKS for t in (c.table, c.parent) if t]
    return sql(
        f"""select name as "check", kind, table_name, column_name, severity, violations,
        if(violations = 0, 'pass', severity) status from ({rows})""",
        *reads,
    )


def counts() -> str:
    parts = [f"select '{name}' table_name, count(*) row_count from {source}" for name, source in RAW_NAMES.items()]
    return sql(" union all ".join(parts), *RAW_NAMES.values())


def marts() -> str:
    stamped = {"dim_customers", "dim_products", "dim_sellers", "fct_orders", "fct_order_items", "fct_payments"}
    names = ["dim_dates", "time_spine", *sorted(stamped)]
    parts = [
        f"""select '{name}' table_name, count(*) row_count, {"count(*)" if name in stamped else 0}::bigint stamped,
          {"sum(gross_revenue)" if name == "fct_orders" else "null"}::{TOTAL} revenue from {name}"""
        for name in names
    ]
    return sql(" union all ".join(parts), *names)


REVIEWS = """
    select cast(l_orderkey as varchar) || '-1' || lpad(cast(l_linenumber as varchar), 6, '0')
        || lpad(cast(l_partkey as varchar), 12, '0') || '1' || lpad(cast(l_suppkey as varchar), 12, '0') review_id,
      cast(l_orderkey as varchar) order_id, (1 + l_partkey % 5)::int review_score,
      '"' || l_returnflag || '" of ' || l_partkey || case when l_partkey % 3 = 0 then chr(10) else ', ' end
        || 'from ' || l_suppkey || chr(10) || chr(10) || l_linestatus review_comment_message
    from lineitem where l_linenumber = 1"""

ORACLE: dict[str, str] = {
    "ingest_reviews": REVIEWS,
    "ingest_row_counts": counts(),
    **{name: table(name) for name in ("stg_customers", "stg_orders", "stg_order_items", "stg_payments")},
    **{name: table(name) for name in ("stg_products", "stg_sellers")},
    "int_order_items_rolled_up": table("item_rollup"),
    "int_payments_rolled_up": table("payment_rollup"),
    "primary_payment_type": table("first_payment"),
    **{name: table(name) for name in ("dim_dates", "time_spine", "dim_customers", "dim_products", "dim_sellers")},
    **{name: table(name) for name in ("fct_orders", "fct_order_items", "fct_payments")},
    "product_weight_distribution": sql(
        "select weight_bucket, count(*) products from dim_products group by 1", "dim_products"
    ),
    "seller_region_distribution": sql("select region, count(*) sellers from dim_sellers group by 1", "dim_sellers"),
    "installment_distribution": sql(
        f"""select installment_bucket, count(*) payments, sum(payment_amount)::{TOTAL} payment_amount
        from fct_payments group by 1""",
        "fct_payments",
    ),
    "surrogate_key": sql(
        f"""select product_id, {key("product_id")} product_key, {key("category_name_pt")} category_key,
          {key("product_id", "category_name_pt")} product_category_key,
          {key("category_name_pt", "product_id")} category_product_key
        from stg_products""",
        "stg_products",
    ),
    "metric_unique_customers_by_grain": sql(
        " union all ".join(
            f"""select '{grain}' grain, date_trunc('{grain}', order_date_key)::date period,
              count(distinct customer_unique_id) unique_customers from fct_orders group by 1, 2"""
            for grain in ("day", "week", "month", "quarter", "year")
        ),
        "fct_orders",
    ),
    "list_metrics": catalogue(),
    "metric_cumulative_revenue": CUMULATIVE_BY_DAY,
    "metric_cumulative_revenue_by_month": CUMULATIVE_BY_MONTH,
    "metric_cumulative_revenue_by_quarter_and_status": CUMULATIVE_BY_QUARTER_AND_STATUS,
    "check_unique": """
        select l_orderkey, l_linenumber, count(*) row_count from lineitem
        where l_orderkey is not null and l_linenumber is not null group by 1, 2 having count(*) > 1""",
    "check_not_null": sql("select * from stg_products where weight_g is null", "stg_products"),
    "check_accepted_values": sql(
        """select order_status, count(*) row_count from stg_orders
        where order_status not in ('delivered', 'shipped', 'canceled', 'invoiced', 'processing', 'created',
          'approved') group by 1""",
        "stg_orders",
    ),
    "check_relationships": sql(
        """select order_date_key, count(*) row_count from fct_orders
        where order_date_key < date '2016-01-01' or order_date_key >= date '2019-01-01' group by 1""",
        "fct_orders",
    ),
    "check_relationships_orders_without_items": sql(
        """select order_id, count(*) row_count from stg_orders
        where order_id not in (select order_id from stg_order_items) group by 1""",
        "stg_orders",
        "stg_order_items",
    ),
    "assert_no_negative_revenue": sql(
        "select order_id, gross_revenue from fct_orders where gross_revenue < 0", "fct_orders"
    ),
    "assert_order_revenue_matches_payments": sql(RECONCILIATION, "fct_orders"),
    "stored_marts": marts(),
    "check_report": report(),
}
