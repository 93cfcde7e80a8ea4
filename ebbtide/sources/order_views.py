"""The four domain tables, derived from an order-entry schema.

Orders become snapshots, urgent orders of low-balance customers become ceases and
line items become calls and daily usage; see FIXTURES.md. The expressions only map
values. Remainders (``%``) decide which *values* are missing or how they vary; no
row of orders or lineitem is left out. The one rule on rows says which orders are
ceases, and is the meaning of that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ebbtide.sources.readers import Tables

CUSTOMER_INFO = """
select cast(o_custkey as string) as unique_customer_identifier,
       cast(o_orderdate as date) as datevalue,
       o_orderkey as snapshot_id,
       case when o_orderkey % 17 = 0 then null else o_orderstatus end as contract_status,
       cast(case when o_orderkey % 5 = 0 then null else o_orderkey % 4 end as int)
         as contract_dd_cancels,
       cast(case when o_orderkey % 7 = 0 then null else o_orderkey % 3 end as int)
         as dd_cancel_60_day,
       cast(floor(o_totalprice / 1000) as int) - 250 as ooc_days,
       datediff(cast(o_orderdate as date), date '1995-01-01') as tenure_days,
       case when o_orderkey % 11 = 0 then null else n_name end as technology,
       case when o_orderkey % 13 = 0 then null
            else cast(20 * (1 + o_orderkey % 4) as double) end as speed,
       case when o_orderkey % 19 = 0 then null
            else cast(20 * (1 + o_orderkey % 4) - (o_custkey % 15) as double) end as line_speed,
       c_mktsegment as sales_channel,
       case when o_orderkey % 23 = 0 then null else o_orderpriority end as crm_package_name
from {orders}
join {customer} on o_custkey = c_custkey
join {nation} on c_nationkey = n_nationkey
"""

CEASE = """
select cast(o_custkey as string) as unique_customer_identifier,
       cast(o_orderdate as date) as cease_placed_date,
       case when o_orderstatus = 'F' then cast(date_add(cast(o_orderdate as date), 14) as string)
            else 'null' end as cease_completed_date,
       n_name as reason_description,
       c_mktsegment as reason_description_insight
from {orders}
join {customer} on o_custkey = c_custkey
join {nation} on c_nationkey = n_nationkey
where o_orderpriority = '1-URGENT' and c_acctbal < 2500
"""

CALLS = """
select cast(o_custkey as string) as unique_customer_identifier,
       cast(l_shipdate as date) as event_date,
       case when l_partkey % 37 = 0 then null
            when l_returnflag = 'R' and l_linestatus = 'F' then 'Loyalty'
            when l_returnflag = 'R' and l_linestatus = 'O' then 'Tech'
            when l_returnflag = 'A' and l_linestatus = 'F' then 'CS&B'
            when l_returnflag = 'A' and l_linestatus = 'O' then 'Customer Finance'
            else 'Other' end as call_type,
       case when l_partkey % 41 = 0 then null else l_quantity * 60 end as talk_time_seconds,
       case when l_partkey % 43 = 0 then null else l_discount * 1000 end as hold_time_seconds
from {lineitem} join {orders} on l_orderkey = o_orderkey
"""

USAGE = """
select cast(o_custkey as string) as unique_customer_identifier,
       cast(l_shipdate as date) as calendar_date,
       l_extendedprice as usage_download_mbs,
       l_extendedprice * l_tax as usage_upload_mbs
from {lineitem} join {orders} on l_orderkey = o_orderkey
"""


def order_views(spark: SparkSession, folder: str) -> Tables:
    """The domain tables over ``folder``/{orders,customer,nation,lineitem}.parquet."""
    base = {
        name: spark.read.parquet(f"{folder}/{name}.parquet")
        for name in ("orders", "customer", "nation", "lineitem")
    }

    def view(query: str) -> DataFrame:
        return spark.sql(query, **{k: v for k, v in base.items() if "{" + k + "}" in query})

    return Tables(
        cease=view(CEASE),
        customer_info=view(CUSTOMER_INFO),
        calls=view(CALLS),
        usage=view(USAGE),
    )
