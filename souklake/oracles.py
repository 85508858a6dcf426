"""The expected results, as SQL text for an independent engine.

Every query is ``WITH`` a chain of named relations, spelled out once below and pulled in by name.
"""

from __future__ import annotations

import re

RELATIONS: dict[str, str] = {}

# --- source tables -----------------------------------------------------------------------------

RELATIONS["src_customers"] = """
select cast(c_custkey as varchar) as customer_id, c_name as customer_unique_id,
  case when c_custkey % 11 <> 0 then lpad(cast(c_custkey % 997 as varchar), 5, '0') end as customer_zip_code_prefix,
  case when c_custkey % 13 <> 0 then '  ' || replace(lower(n_name), '_', '-d''oeste ') || ' ' end as customer_city,
  case when c_custkey % 17 <> 0 then ' ' || lower(substring(r_name, 1, 2)) || ' ' end as customer_state
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""

RELATIONS["src_sellers"] = """
select cast(s_suppkey as varchar) as seller_id,
  case when s_suppkey % 7 <> 0 then lpad(cast(s_suppkey % 997 as varchar), 5, '0') end as seller_zip_code_prefix,
  ' ' || replace(n_name, '_', '/') || ' ' as seller_city, lower(substring(r_name, 1, 2)) as seller_state
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""

RELATIONS["src_products"] = """
select cast(p_partkey as varchar) as product_id,
  case when p_partkey % 19 <> 0 then ' ' || p_type || ' ' end as product_category_name,
  cast(length(p_name) as integer) as product_name_lenght,
  case when p_partkey % 23 <> 0 then p_size * 10 end as product_description_lenght,
  p_size % 6 as product_photos_qty, p_retailprice as product_weight_g,
  case when p_partkey % 29 <> 0 then p_size end as product_length_cm,
  p_size % 10 + 1 as product_height_cm, p_size % 7 as product_width_cm
from part"""

RELATIONS["src_product_category_name_translation"] = """
select distinct p_type as product_category_name, lower(p_type) || '_goods' as product_category_name_english
from part where p_type <> 'PROMO'"""

RELATIONS["src_order_items"] = """
select cast(l_orderkey as varchar) as order_id,
  cast(row_number() over (partition by l_orderkey
    order by l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) as integer) as order_item_id,
  cast(l_partkey as varchar) as product_id, cast(l_suppkey as varchar) as seller_id,
  l_shipdate as shipping_limit_date, cast(l_extendedprice as decimal(12,2)) as price,
  cast(l_extendedprice as decimal(12,2)) * cast(l_tax as decimal(4,2)) as freight_value
from lineitem"""

RELATIONS["src_orders"] = """
select cast(o_orderkey as varchar) as order_id, cast(o_custkey as varchar) as customer_id,
  case o_orderstatus when 'F' then ' Delivered ' when 'O' then 'SHIPPED' else 'canceled' end as order_status,
  o_orderdate as order_purchase_timestamp,
  o_orderdate + to_hours(o_orderkey % 48) as order_approved_at,
  o_orderdate + to_hours(48 + o_orderkey % 72) as order_delivered_carrier_date,
  case when o_orderstatus <> 'P' then o_orderdate + to_hours(96 + (o_orderkey * 37) % 900) end
    as order_delivered_customer_date,
  o_orderdate + to_hours(24 * (10 + o_orderkey % 25)) as order_estimated_delivery_date
from orders"""

RELATIONS["src_order_payments"] = """
select cast(o_orderkey as varchar) as order_id, cast(seq as integer) as payment_sequential,
  case when o_orderkey % 9 = 0 and seq = 2 then ' Voucher ' when o_orderpriority = '1-URGENT' then 'boleto'
    else 'CREDIT_CARD' end as payment_type,
  1 + o_orderkey % 4 as payment_installments,
  case when seq = 1 then cast(o_totalprice as decimal(12,2)) else cast(10.00 as decimal(12,2)) end as payment_value
from orders, (values (1), (2)) s(seq) where seq = 1 or o_orderkey % 3 = 0"""

RELATIONS["src_order_reviews"] = """
select cast(event_id as varchar) as review_id, cast(event_id as varchar) as order_id,
  1 + event_id % 5 as review_score,
  case when event_id % 2 <> 0 then ' ' || event_type || ' ' end as review_comment_title,
  c.message as review_comment_message, ts as review_creation_date,
  case when event_id % 31 <> 0 then ts + to_hours(event_id % 97) end as review_answer_timestamp
from events left join (select conv_id, string_agg(text, chr(10) order by turn, role, text) as message
  from conversations group by conv_id) c on c.conv_id = event_id"""

RELATIONS["src_marketing_qualified_leads"] = """
select cast(event_id as varchar) as mql_id, 'lp' || cast(user_id % 12 as varchar) as landing_page_id,
  case when user_id % 10 = 0 then null when user_id % 3 = 0 then ' Organic_Search'
    when user_id % 3 = 1 then 'PAID_SEARCH ' else 'social' end as origin,
  ts as first_contact_date
from events where event_type = 'signup'"""

RELATIONS["src_closed_deals"] = """
select cast(event_id as varchar) as mql_id, cast(user_id as varchar) as seller_id,
  'sdr' || cast(user_id % 5 as varchar) as sdr_id, 'sr' || cast(user_id % 7 as varchar) as sr_id,
  ts + to_hours(event_id % 400) as won_date, ' Home_Decor ' as business_segment,
  case when event_id % 4 <> 1 then 'ONLINE_BIG' end as lead_type, 'cat' as lead_behaviour_profile,
  case event_id % 4 when 0 then 'true' when 2 then 'false' end as has_company,
  case event_id % 3 when 0 then 't' when 1 then 'no' end as has_gtin,
  cast(null as varchar) as average_stock, 'Reseller' as business_type,
  event_id % 50 as declared_product_catalog_size, cast(cast(value as decimal(12,2)) * 1000 as decimal(14,2)) as declared_monthly_revenue
from events where event_type = 'signup' and event_id % 3 <> 2"""


# --- cleaning models ---------------------------------------------------------------------------


def initcap(text: str) -> str:
    words = f"regexp_extract_all({text}, '([\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+)')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || lower(w[2:])), '')"


def key(*parts: str) -> str:
    texts = ", ".join(f"coalesce(cast({p} as varchar), '_null_')" for p in parts)
    return f"md5(concat_ws('-', {texts}))"


def days(later: str, earlier: str) -> str:
    return f"cast(extract(day from {later} - {earlier}) as integer)"


def hours(later: str, earlier: str) -> str:
    return f"date_diff('microsecond', {earlier}, {later}) / cast(3.6e9 as double)"


_BOOL = "case lower(trim({0})) when 'on' then true when 'off' then false else cast({0} as boolean) end"

RELATIONS["stg_orders"] = """
select order_id, customer_id, lower(trim(order_status)) as order_status,
  order_purchase_timestamp as order_purchase_at, order_approved_at,
  order_delivered_carrier_date as order_delivered_carrier_at,
  order_delivered_customer_date as order_delivered_customer_at,
  order_estimated_delivery_date as order_estimated_delivery_at
from src_orders"""

RELATIONS["stg_order_items"] = """
select order_id, order_item_id, product_id, seller_id, shipping_limit_date as shipping_limit_at,
  price::decimal(10,2) as price, freight_value::decimal(10,2) as freight_value
from src_order_items"""

RELATIONS["stg_order_payments"] = """
select order_id, payment_sequential, lower(trim(payment_type)) as payment_type,
  payment_installments::integer as payment_installments, payment_value::decimal(10,2) as payment_value
from src_order_payments"""

RELATIONS["stg_order_reviews"] = """
select review_id, order_id, review_score::integer as review_score,
  trim(review_comment_title) as review_comment_title, trim(review_comment_message) as review_comment_message,
  review_creation_date as review_created_at, review_answer_timestamp as review_answered_at
from src_order_reviews"""

RELATIONS["stg_customers"] = f"""
select customer_id, customer_unique_id, customer_zip_code_prefix,
  {initcap("trim(customer_city)")} as customer_city, upper(trim(customer_state)) as customer_state
from src_customers"""

RELATIONS["stg_sellers"] = f"""
select seller_id, seller_zip_code_prefix,
  {initcap("trim(seller_city)")} as seller_city, upper(trim(seller_state)) as seller_state
from src_sellers"""

RELATIONS["stg_products"] = """
select product_id, lower(trim(product_category_name)) as product_category_name,
  product_name_lenght as product_name_length, product_description_lenght as product_description_length,
  product_photos_qty, product_weight_g::decimal(10,2) as product_weight_g,
  product_length_cm::decimal(10,2) as product_length_cm, product_height_cm::decimal(10,2) as product_height_cm,
  product_width_cm::decimal(10,2) as product_width_cm
from src_products"""

RELATIONS["stg_marketing_qualified_leads"] = """
select mql_id, landing_page_id, lower(trim(origin)) as origin, first_contact_date as first_contact_at
from src_marketing_qualified_leads"""

RELATIONS["stg_closed_deals"] = f"""
select mql_id, seller_id, sdr_id, sr_id, won_date as won_at, lower(trim(business_segment)) as business_segment,
  lower(trim(lead_type)) as lead_type, lower(trim(lead_behaviour_profile)) as lead_behaviour_profile,
  lower(trim(business_type)) as business_type,
  {_BOOL.format("has_company")} as has_company, {_BOOL.format("has_gtin")} as has_gtin, average_stock,
  declared_product_catalog_size::decimal(10,2) as declared_product_catalog_size,
  declared_monthly_revenue::decimal(10,2) as declared_monthly_revenue
from src_closed_deals"""

RELATIONS["stg_product_category_name"] = """
select lower(trim(product_category_name)) as product_category_name,
  lower(trim(product_category_name_english)) as product_category_name_english
from src_product_category_name_translation"""

# --- dimensions --------------------------------------------------------------------------------

RELATIONS["dim_customers"] = f"""
select {key("customer_id")} as customer_key, customer_id, customer_unique_id,
  ifnull(customer_zip_code_prefix, 'unknown') as customer_zip_code_prefix,
  ifnull(customer_city, 'unknown') as customer_city, ifnull(customer_state, 'unknown') as customer_state
from stg_customers"""

RELATIONS["dim_sellers"] = f"""
select {key("seller_id")} as seller_key, seller_id,
  ifnull(seller_zip_code_prefix, 'unknown') as seller_zip_code_prefix,
  ifnull(seller_city, 'unknown') as seller_city, ifnull(seller_state, 'unknown') as seller_state
from stg_sellers"""

RELATIONS["dim_products"] = f"""
select {key("product_id")} as product_key, product_id,
  ifnull(p.product_category_name, 'nao_informado') as product_category_name_pt,
  ifnull(t.product_category_name_english, 'others/unspecified') as product_category_name,
  ifnull(product_name_length, 0) as product_name_length,
  ifnull(product_description_length, 0) as product_description_length,
  ifnull(product_photos_qty, 0) as product_photos_qty,
  ifnull(product_weight_g, 0)::decimal(10,2) as product_weight_g,
  ifnull(product_length_cm, 0)::decimal(10,2) as product_length_cm,
  ifnull(product_height_cm, 0)::decimal(10,2) as product_height_cm,
  ifnull(product_width_cm, 0)::decimal(10,2) as product_width_cm,
  ifnull(product_length_cm::decimal(30,2) * product_height_cm * product_width_cm, 0)::decimal(30,6) as product_volume_cm3
from stg_products p left join stg_product_category_name t using (product_category_name)"""

RELATIONS["dim_marketing_leads"] = f"""
select {key("l.mql_id")} as mql_key, l.mql_id, d.seller_id, d.sdr_id, d.sr_id,
  ifnull(landing_page_id, 'unknown') as landing_page_id, ifnull(origin, 'unknown') as origin,
  ifnull(business_segment, 'unknown') as business_segment, ifnull(lead_type, 'unknown') as lead_type,
  ifnull(lead_behaviour_profile, 'unknown') as lead_behaviour_profile,
  ifnull(business_type, 'unknown') as business_type,
  has_company is not distinct from true as has_company, has_gtin is not distinct from true as has_gtin,
  d.seller_id is not null as is_won
from stg_marketing_qualified_leads l left join stg_closed_deals d on d.mql_id = l.mql_id"""

# --- facts -------------------------------------------------------------------------------------

RELATIONS["fact_sales"] = f"""
select {key("i.order_id", "i.order_item_id")} as sales_item_key, i.order_id, i.order_item_id,
  c.customer_key, p.product_key, s.seller_key, o.order_status, o.order_purchase_at, o.order_approved_at,
  o.order_delivered_carrier_at, o.order_delivered_customer_at, o.order_estimated_delivery_at,
  i.shipping_limit_at, i.price, i.freight_value, (i.price + i.freight_value)::decimal(11,2) as total_item_amount,
  {days("o.order_delivered_customer_at", "o.order_purchase_at")} as delivery_duration_days,
  {days("o.order_estimated_delivery_at", "o.order_delivered_customer_at")} as delivery_delay_vs_estimated_days,
  ifnull(o.order_delivered_customer_at > o.order_estimated_delivery_at, false) as is_late_delivery
from stg_order_items i join stg_orders o on o.order_id = i.order_id
  left join dim_customers c on c.customer_id = o.customer_id
  left join dim_products p on p.product_id = i.product_id
  left join dim_sellers s on s.seller_id = i.seller_id"""

RELATIONS["fact_payments"] = f"""
select {key("y.order_id", "y.payment_sequential")} as payment_key, y.order_id, y.payment_sequential,
  c.customer_key, y.payment_type, o.order_status, o.order_purchase_at, y.payment_installments, y.payment_value,
  ifnull(y.payment_installments > 1, false) as is_installment,
  ifnull(y.payment_type = 'voucher', false) as is_voucher_used
from stg_order_payments y join stg_orders o on o.order_id = y.order_id
  left join dim_customers c on c.customer_id = o.customer_id"""

RELATIONS["order_items_summary"] = """
select order_id, max(product_id) as product_id, max(seller_id) as seller_id,
  count(order_item_id) as total_items_in_order
from stg_order_items group by order_id"""

RELATIONS["fact_reviews"] = f"""
select {key("r.review_id", "r.order_id")} as review_key, r.review_id, r.order_id,
  c.customer_key, p.product_key, s.seller_key, r.review_score, r.review_comment_title, r.review_comment_message,
  r.review_created_at, r.review_answered_at, o.order_purchase_at,
  {hours("r.review_answered_at", "r.review_created_at")} as review_response_time_hours,
  ifnull(r.review_score >= 4, false) as is_satisfied, r.review_comment_message is not null as has_comment
from stg_order_reviews r join stg_orders o on o.order_id = r.order_id
  left join order_items_summary m on m.order_id = r.order_id
  left join dim_customers c on c.customer_id = o.customer_id
  left join dim_products p on p.product_id = m.product_id
  left join dim_sellers s on s.seller_id = m.seller_id"""

RELATIONS["seller_performance"] = """
select seller_key, min(order_purchase_at) as first_sale_at, count(distinct order_id) as total_orders_completed,
  sum(price)::decimal(20,2) as total_gross_revenue
from fact_sales group by seller_key"""

RELATIONS["fact_marketing_funnel"] = f"""
select {key("l.mql_id")} as funnel_key, m.mql_key, s.seller_key, l.mql_id, d.seller_id, d.sdr_id, d.sr_id,
  l.first_contact_at, d.won_at, f.first_sale_at, {days("d.won_at", "l.first_contact_at")} as days_to_close,
  {days("f.first_sale_at", "d.won_at")} as days_to_first_sale,
  d.declared_product_catalog_size, d.declared_monthly_revenue,
  ifnull(f.total_orders_completed, 0) as total_orders_completed,
  ifnull(f.total_gross_revenue, 0)::decimal(20,2) as total_gross_revenue,
  d.seller_id is not null as is_won, ifnull(f.total_orders_completed > 0, false) as is_active_seller
from stg_marketing_qualified_leads l
  left join stg_closed_deals d on d.mql_id = l.mql_id
  left join dim_marketing_leads m on m.mql_id = l.mql_id
  left join dim_sellers s on s.seller_id = d.seller_id
  left join seller_performance f on f.seller_key = s.seller_key"""


# The columns of the marts.
MART_COLUMNS = {
    "dim_customers": (
        "customer_key", "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
        "customer_state",
    ),
    "dim_products": (
        "product_key", "product_id", "product_category_name_pt", "product_category_name",
        "product_name_length", "product_description_length", "product_photos_qty", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm", "product_volume_cm3",
    ),
    "dim_sellers": (
        "seller_key", "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state",
    ),
    "dim_marketing_leads": (
        "mql_key", "mql_id", "seller_id", "sdr_id", "sr_id", "landing_page_id", "origin", "business_segment",
        "lead_type", "lead_behaviour_profile", "business_type", "has_company", "has_gtin", "is_won",
    ),
    "fact_sales": (
        "sales_item_key", "order_id", "order_item_id", "customer_key", "product_key", "seller_key",
        "order_status", "order_purchase_at", "order_approved_at", "order_delivered_carrier_at",
        "order_delivered_customer_at", "order_estimated_delivery_at", "shipping_limit_at", "price",
        "freight_value", "total_item_amount", "delivery_duration_days", "delivery_delay_vs_estimated_days",
        "is_late_delivery",
    ),
    "fact_payments": (
        "payment_key", "order_id", "payment_sequential", "customer_key", "payment_type", "order_status",
        "order_purchase_at", "payment_installments", "payment_value", "is_installment", "is_voucher_used",
    ),
    "fact_reviews": (
        "review_key", "review_id", "order_id", "customer_key", "product_key", "seller_key", "review_score",
        "review_comment_title", "review_comment_message", "review_created_at", "review_answered_at",
        "order_purchase_at", "review_response_time_hours", "is_satisfied", "has_comment",
    ),
    "fact_marketing_funnel": (
        "funnel_key", "mql_key", "seller_key", "mql_id", "seller_id", "sdr_id", "sr_id", "first_contact_at",
        "won_at", "first_sale_at", "days_to_close", "days_to_first_sale", "declared_product_catalog_size",
        "declared_monthly_revenue", "total_orders_completed", "total_gross_revenue", "is_won",
        "is_active_seller",
    ),
}

# --- earlier states of the sources ---------------------------------------------------------------


def orders_as_of(moment: str) -> str:
    """Orders as the source showed them at a moment: later orders unknown, later deliveries open."""
    late = f"order_delivered_customer_date >= timestamp '{moment}'"
    return f"""
select * replace (
  case when {late} then 'SHIPPED' else order_status end as order_status,
  case when {late} then null else order_delivered_customer_date end as order_delivered_customer_date)
from src_orders where order_purchase_timestamp < timestamp '{moment}'"""


RELATIONS["orders_2000"] = orders_as_of("2000-01-01 00:00:00")


def upserted(target: str, batch: str, *keys: str) -> str:
    same = " and ".join(f"b.{k} = t.{k}" for k in keys)
    kept = f"select * from {target} t where not exists (select 1 from {batch} b where {same})"
    return f"{kept} union all by name select * from {batch}"


def snapshot_first(rows: str, by: str, as_of: str) -> str:
    moment = f"timestamp '{as_of}'"
    return f"""
select *, {moment} as valid_from, cast(null as timestamp) as valid_to, {moment} as updated_at,
  {key(by, moment)} as scd_id
from {rows}"""


def snapshot_second(before: str, after: str, by: str, checks: tuple[str, ...], first: str, second: str) -> str:
    """History after two runs, spelled out as one branch per fate of a key."""
    t1, t2 = f"timestamp '{first}'", f"timestamp '{second}'"
    changed = " or ".join(f"a.{c} is distinct from b.{c}" for c in checks)

    def part(alias: str, since: str, until: str, rest: str) -> str:
        # A row's update stamp is the time at which it was opened, also after it is closed.
        return (
            f"select {alias}.*, {since} as valid_from, cast({until} as timestamp) as valid_to, "
            f"{since} as updated_at, {key(f'{alias}.{by}', since)} as scd_id {rest}"
        )

    both = f"from {before} a join {after} b using ({by})"
    return "\nunion all by name\n".join(
        [
            part("a", t1, "null", f"{both} where not ({changed})"),
            part("a", t1, t2, f"{both} where {changed}"),
            part("b", t2, "null", f"{both} where {changed}"),
            part("a", t1, t2, f"from {before} a anti join {after} b using ({by})"),
            part("b", t2, "null", f"from {after} b anti join {before} a using ({by})"),
        ]
    )


def suite(specs, relation_of) -> str:
    """One count per declared test."""
    counts = []
    for spec in specs:
        source, column = relation_of(spec.table), spec.column
        if spec.test == "unique":
            failing = f"(select {column} from {source} where {column} is not null group by 1 having count(*) > 1)"
        elif spec.test == "relationships":
            parent = f"select {spec.parent_column} from {relation_of(spec.parent)}"
            failing = f"{source} c where {column} is not null and not exists ({parent} p where p.{spec.parent_column} = c.{column})"
        else:
            failing = f"{source} where {column} is null"
        counts.append(
            f"select '{spec.table}' as table_name, '{column}' as column_name, '{spec.test}' as test, "
            f"count(*) as failures from {failing}"
        )
    return "\nunion all ".join(counts)


# --- composition -------------------------------------------------------------------------------


def _needs(sql: str, known: dict[str, str]) -> list[str]:
    words = set(re.findall(r"\w+", sql))
    return [name for name in known if name in words]


def with_relations(sql: str, extra: dict[str, str] | None = None) -> str:
    """Put every relation that ``sql`` names, directly or not, in front of it."""
    known = RELATIONS | (extra or {})
    ordered: dict[str, str] = {}

    def visit(name: str) -> None:
        if name in ordered:
            return
        for inner in _needs(known[name], known):
            if inner != name:
                visit(inner)
        ordered[name] = known[name]

    for name in _needs(sql, known):
        visit(name)
    if not ordered:
        return sql
    body = ",\n".join(f"{name} as ({text.strip()}\n)" for name, text in ordered.items())
    return f"with {body}\n{sql.strip()}"


def relation(name: str) -> str:
    return with_relations(f"select * from {name}")
