"""SQL over the same tables that must give the same rows as the query of that name."""

from __future__ import annotations

_EVENT_JSON = """select cast(json_object('event_id', event_id, 'user_id', user_id, 'event_type', event_type,
       'value', value) as varchar) as value"""

_LATEST_LINE = """qualify row_number() over (partition by l_orderkey
          order by l_shipdate desc, l_linenumber desc, l_partkey desc, l_suppkey desc) = 1"""

_LATEST = f"""select l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity,
       l_extendedprice, l_returnflag from lineitem {_LATEST_LINE}"""

_REGION = """join customer on o_custkey = c_custkey
       join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""

_SALES = f"""
with b as (
  select l_orderkey, cast(l_quantity as int) q, l_extendedprice p, cast(l_shipdate as date) d, r_name region
  from lineitem join orders on l_orderkey = o_orderkey {_REGION}
  {_LATEST_LINE})
select d as order_day, region, round(sum(q * p), 2) as total_revenue, cast(sum(q) as bigint) as total_units
from b group by 1, 2"""

_VERSIONS = f"""
with versions as (
  select printf('ORD-%08d', o_orderkey) as order_id, cast(o_orderdate as date) as order_date, 1 as quantity,
         o_totalprice as price, r_name as region, 0 as line, 0 as part, 0 as supp
  from orders {_REGION}
  union all
  select printf('ORD-%08d', l_orderkey), cast(l_shipdate as date), cast(l_quantity as int), l_extendedprice, r_name,
         l_linenumber, l_partkey, l_suppkey
  from lineitem join orders on l_orderkey = o_orderkey {_REGION}),
current as (
  select order_id, order_date, quantity, price, region from versions
  qualify row_number() over (partition by order_id order by order_date desc, line desc, part desc, supp desc) = 1)"""

_REGIONAL = f"""select cast(o_orderdate as date) as order_day, r_name as region,
       round(sum(o_totalprice), 2) as total_revenue, count(*) as total_units
from orders {_REGION} group by 1, 2"""

_CURRENT_SUMS = f"""{_VERSIONS}
select order_date as order_day, region, round(sum(quantity * price), 2) as total_revenue,
       cast(sum(quantity) as bigint) as total_units
from current group by 1, 2"""

_DAILY = """select cast(l_shipdate as date) as order_day, l_returnflag,
       round(sum(cast(l_quantity as int) * l_extendedprice), 2) as total_revenue,
       cast(sum(cast(l_quantity as int)) as bigint) as total_units
from lineitem group by 1, 2"""

_UPSERT_ORDERS = """select o_orderkey, o_orderpriority, o_totalprice from orders t
where not exists (select 1 from orders s where s.o_orderkey * 2 = t.o_orderkey)
union all
select o_orderkey * 2, 'REVISED', cast(-1 as double) from orders"""

_UPSERT_LINES = """with lines as (
  select l_orderkey, l_linenumber, l_quantity, l_returnflag from lineitem
  qualify row_number() over (partition by l_orderkey, l_linenumber
          order by l_shipdate desc, l_partkey desc, l_suppkey desc) = 1)
select l_orderkey, l_linenumber, l_quantity, l_returnflag from lines t
where not exists (select 1 from lines s where s.l_orderkey = t.l_orderkey and s.l_linenumber + 1 = t.l_linenumber)
union all
select l_orderkey, l_linenumber + 1, cast(0 as double), 'X' from lines"""

ORACLES = {
    "medallion_sales": _SALES,
    "medallion_files": _SALES,
    "lineage_file": """select event_id, event_type, 'file' as source_system, 'events.parquet' as source_file,
       true as stamped from events""",
    "lineage_stream": """select event_id, event_type, 'kafka' as source_system, cast(null as varchar) as source_file,
       true as stamped from events""",
    "decode_raw": f"{_EVENT_JSON} from events",
    "decode_json": "select event_id, cast(props->>'k' as int) as k, true as well_formed from events",
    "encode_json": f"{_EVENT_JSON} from events",
    "typed_projection": """select o_orderkey,
       case when o_orderpriority <> '1-URGENT' then cast(o_orderdate as date) end as order_date,
       case when o_orderpriority <> '2-HIGH' then o_totalprice end as price,
       case o_orderpriority when '3-MEDIUM' then null when '4-NOT SPECIFIED' then 0 else cast(o_custkey as int) end as quantity
from orders""",
    "split_rejects": """select case when o_orderpriority <> '1-URGENT' then o_orderkey end as order_id, o_totalprice,
       o_orderpriority = '1-URGENT' as rejected from orders""",
    "dedup_latest": _LATEST,
    "dedup_latest_aggregate": _LATEST,
    "upsert_one_key": _UPSERT_ORDERS,
    "upsert_stored_one_key": _UPSERT_ORDERS,
    "upsert_two_keys": _UPSERT_LINES,
    "upsert_stored_two_keys": _UPSERT_LINES,
    "upsert_own_names": f"""with o as ({_UPSERT_ORDERS})
select o_orderkey, o_orderpriority, o_orderpriority as slot, o_orderkey as key_bucket, o_totalprice as _rank,
       o_orderpriority as _from_source, o_totalprice as _piece, o_orderkey as _task, o_orderpriority as _change,
       o_totalprice as _new from o""",
    "upsert_appended": """select l_orderkey, l_linenumber, l_quantity, l_returnflag from lineitem
  qualify row_number() over (partition by l_orderkey, l_linenumber
          order by l_shipdate desc, l_partkey desc, l_suppkey desc) = 1""",
    "upsert_create": "select o_orderkey, o_orderpriority, o_totalprice from orders",
    "daily_gold": _DAILY,
    "daily_gold_refresh": _DAILY,
    "gold_table": """select cast(ts as date) as event_day, event_type, round(sum(value), 2) as total_revenue,
       cast(sum(cast(user_id as int)) as bigint) as total_units from events group by 1, 2""",
    "gold_table_monthly": _DAILY,
    "ingest_files": "select event_id, user_id, event_type, value, props, 'file' as source_system from events",
    "ingest_evolving": """select event_id, event_type, case when event_id % 3 <> 0 then value end as value
       from events""",
    "ingest_odd_names": """with e as (select *, event_id % 4 <> 0 as late from events)
select event_id, event_type, case when late then value end as value, case when late then user_id end as user_id,
       case when late then event_type end as event_type_again, case when late then event_id end as event_id_again,
       case when late then user_id end as user_id_again, case when late then value end as value_again, true as from_landing
from e""",
    "stream_continuous": "select event_id, user_id, event_type, value, 'kafka' as source_system from events",
    "overwrite_plain": "select o_orderkey, o_totalprice, o_orderstatus from orders",
    "upsert_recent": """select o_orderkey, o_orderpriority, o_totalprice from orders t
where not exists (select 1 from orders s where s.o_orderkey + 10000 = t.o_orderkey)
union all
select o_orderkey + 10000, 'LATER', o_totalprice from orders""",
    "gold_table_by_region": _REGIONAL,
    "gold_view": _REGIONAL,
    "silver_bad_input": f"""
with o as (
  select o_orderkey k, printf('ORD-%08d', o_orderkey) as order_id, cast(o_orderdate as date) as d, o_totalprice as p,
         r_name as region from orders {_REGION})
select order_id, case when k % 5 <> 3 then d end as order_date, case when k % 5 <> 1 then 3 end as quantity,
       case when k % 5 <> 2 then p end as price, region, false as malformed, false as rejected from o where k % 7 <> 0
union all
select null, null, null, null, null, true, true from o where k % 7 = 0""",
    "silver_by_arrival": f"""
with o as (
  select o_orderkey, printf('ORD-%08d', o_orderkey) as order_id, cast(o_orderdate as date) as order_date, 1 as quantity,
         o_totalprice as price, r_name as region from orders {_REGION})
select order_id, case when o_orderkey % 2 = 0 and o_orderkey % 10 <> 0 then order_date
         else cast(order_date + interval 12 month as date) end as order_date,
       quantity, price, region, true as stamped, false as rejected from o
union all
select cast(null as varchar), order_date, quantity, price, region, true, true from o where o_orderkey % 10 = 0""",
    "ingest_archived": "select event_id, event_type, value from events",
    "ingest_restart": "select event_id, event_type, value from events",
    "ingest_partitioned": "select event_id, value, true as same_day from events",
    "ingest_messages_json": """select event_id, user_id, event_type, value, 'kafka' as source_system,
       cast(null as varchar) as source_file from events""",
    "ingest_messages_undeclared": """select event_id, event_type, user_id, value, 'user_id,value' as kept_aside
       from events""",
    "ingest_messages_raw": f"{_EVENT_JSON}, 'kafka' as source_system from events",
    "ingest_all_specs": """select event_id, event_type, source_system
from events, (select unnest(['file', 'kafka']) as source_system)""",
    "export_landing": "select o_orderkey, o_custkey, o_totalprice, o_orderpriority from orders",
    "overwrite_partitioned": "select o_orderkey, o_totalprice, o_orderstatus from orders",
    "silver_incremental": f"{_VERSIONS} select * from current",
    "silver_appended": f"{_VERSIONS} select * from current",
    "silver_volumes": f"""{_VERSIONS}
select c.*, n.versions from current c join (select order_id, count(*) as versions from versions group by 1) n using (order_id)""",
    "silver_full": f"{_VERSIONS} select * from current",
    "gold_refresh": _CURRENT_SUMS,
    "gold_from_changes": _CURRENT_SUMS,
}
