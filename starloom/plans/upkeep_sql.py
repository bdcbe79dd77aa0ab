"""DuckDB SQL of the queries in ``upkeep``."""

from __future__ import annotations

from starloom.operators import quality_trend as qt
from starloom.operators import zorder
from starloom.plans.oracle import EV, HISTORY_SCD2, NET_REV
from starloom.plans.upkeep import BREAK_DAYS, EVENTS_CUT, ORDERS_CUT

OLD = f"o_orderdate < TIMESTAMP '{ORDERS_CUT}'"

INGEST_BY_HEADER = f"""
select o_orderkey + case when {OLD} then 0 else 4000000000 end as "OrderKey", CAST(o_custkey AS INTEGER) as "CustKey",
  case when {OLD} then floor(o_totalprice) else o_totalprice end as "Total", o_orderstatus as "Status", o_orderdate as "OrderDate",
  CAST(null AS VARCHAR) as "Clerk", case when {OLD} then null else o_orderpriority end as "Priority" from orders"""

INGEST_INCREMENTAL = """
select o_orderkey as "OrderKey", case when low and o_orderstatus = 'P' then null else o_totalprice end as "Total",
  case when high then o_orderstatus || '*' else o_orderstatus end as "Status",
  low and o_orderstatus = 'P' as rejected, CAST(case when high or low then 2 else 1 end AS BIGINT) as run
from (select *, o_orderpriority = '2-HIGH' as high, o_orderpriority = '5-LOW' as low from orders where o_orderpriority <> '1-URGENT')"""

HOURS = f"select *, CAST(hour(ts) AS INTEGER) as hour from ({EV})"


def _last(where: str) -> str:
    return f"""select event_id, ts, user_id, event_type, value, hour from (select *, row_number() over
  (partition by user_id, event_type, hour order by ts desc, event_id desc) as rn from ({HOURS}) where {where}) where rn = 1"""


HISTORY_MERGE = f"""
with t as ({_last(f"ts < TIMESTAMP '{EVENTS_CUT}'")}), s as ({_last(f"ts >= TIMESTAMP '{EVENTS_CUT}'")}),
j as (select coalesce(t.user_id, s.user_id) as user_id, coalesce(t.event_type, s.event_type) as event_type, coalesce(t.hour, s.hour) as hour,
  t.event_id as te, t.ts as tt, t.value as tv, s.event_id as se, s.ts as st, s.value as sv,
  t.user_id is not null as has_t, s.user_id is not null as has_s
  from t full outer join s on t.user_id = s.user_id and t.event_type = s.event_type and t.hour = s.hour),
a as (select *, case
  when has_t and has_s then case when event_type = 'error' then 'delete' when sv > tv then 'update' when sv < 5 then 'touch' else 'keep' end
  when has_s then case when sv >= 1 then 'insert' else 'ignore' end
  else case when event_type = 'view' then 'delete' when tv < 10 then 'zero' else 'keep' end end as what from j)
select case what when 'touch' then 'update' when 'zero' then 'update' else what end as action,
  case when what in ('update', 'insert', 'ignore') then se else te end as event_id,
  case when what in ('update', 'insert', 'ignore', 'touch') then st else tt end as ts, user_id, event_type,
  case when what in ('update', 'insert', 'ignore') then sv when what = 'zero' then 0 else tv end as value, hour from a"""

MART_DELTA = f"""
select CAST(year(o_orderdate) AS INTEGER) as order_year, o_orderpriority, count(*) as rows,
  CAST(sum(CAST(price AS DECIMAL(15,2))) AS DOUBLE) as total, min(price) as least, max(price) as most
from (select *, case when {OLD} and o_orderstatus = 'P' then floor(o_totalprice / 2) else o_totalprice end as price
      from orders where not ({OLD} and o_totalprice >= 400000))
group by 1, 2"""

QUARTERS = "CAST(year(o_orderdate) AS INTEGER) as order_year, CAST(quarter(o_orderdate) AS INTEGER) as order_quarter"

MART_PRODUCTS = f"""
select brand, order_year, order_quarter, count(distinct o_custkey) as buyers, count(*) as line_count,
  CAST(sum(CAST(l_quantity AS DECIMAL(15,2))) AS DOUBLE) as total_qty, CAST(sum({NET_REV}) AS DOUBLE) as net_revenue,
  CAST(grouping(brand, order_year, order_quarter) AS INTEGER) as grouping_level
from (select p_brand as brand, {QUARTERS}, o_custkey, l_quantity, l_extendedprice, l_discount
      from lineitem join orders on l_orderkey = o_orderkey left join part on l_partkey = p_partkey)
group by rollup (brand, order_year, order_quarter)"""

MART_SEGMENTS = f"""
with r as (select l_orderkey, sum({NET_REV}) as rev from lineitem group by l_orderkey)
select segment, order_year, order_quarter, count(distinct o_custkey) as customers, count(*) as order_count,
  CAST(sum(rev) AS DOUBLE) as net_revenue, CAST(grouping(segment, order_year, order_quarter) AS INTEGER) as grouping_level
from (select c_mktsegment as segment, {QUARTERS}, o_custkey, rev from orders left join r on o_orderkey = l_orderkey left join customer on o_custkey = c_custkey)
group by rollup (segment, order_year, order_quarter)"""


def _zorder(cols: list[str], table: str, keep: str) -> str:
    n, k = 1 << zorder.BITS, len(cols)
    shares = ", ".join(str(i / n) for i in range(1, n))
    bounds = ", ".join(f"list_distinct(quantile_disc({c}, [{shares}])) as b_{c}" for c in cols)
    ranks = ", ".join(f"case when {c} is null then 0 else len(list_filter(b_{c}, lambda b: b <= {c})) end as r_{c}" for c in cols)
    bits = " + ".join(f"(((r_{c} >> {b}) & 1) << {b * k + j})" for b in range(zorder.BITS) for j, c in enumerate(cols))
    return f"""with q as (select {bounds} from {table}), r as (select {keep}, {ranks} from {table}, q)
select {keep}, CAST({bits} AS BIGINT) as z from r"""


LAYOUT_ZORDER = _zorder(["l_shipdate", "l_partkey"], "lineitem", "l_orderkey, l_linenumber")

LAYOUT_COMPACTION = "select o_orderkey, o_totalprice, o_orderstatus, CAST(1 AS BIGINT) as files from orders"


def _middle(xs: str) -> str:
    return f"(case when len({xs}) > 0 then ({xs}[(len({xs}) + 1) // 2] + {xs}[len({xs}) // 2 + 1]) / 2 end)"


DQ_TREND = f"""
with e as (select CAST(ts AS DATE) as run, event_type,
    case when CAST(ts AS DATE) = DATE '{BREAK_DAYS[1]}' and event_type = 'click' then null else value end as value
  from events where not coalesce(CAST(ts AS DATE) = DATE '{BREAK_DAYS[0]}' and event_type = 'view', false)),
d as (select run, CAST(count(*) AS DOUBLE) as n, CAST(count_if(value is null) AS DOUBLE) / count(*) as nv, CAST(count_if(event_type is null) AS DOUBLE) / count(*) as ne,
    CAST(sum(CAST(value AS DECIMAL(30,6))) AS DOUBLE) / nullif(count(value), 0) as m from e group by run),
h as (select run, 'rows' as metric, CAST(null AS VARCHAR) as "column", n as value from d union all select run, 'null_share', 'value', nv from d
  union all select run, 'null_share', 'event_type', ne from d union all select run, 'mean', 'value', m from d),
p as (select *, coalesce(list_sort(list(value) filter (value is not null) over (partition by metric, "column" order by run
    rows between {qt.RUNS} preceding and 1 preceding)), []) as past from h),
x as (select * exclude (past), past, {_middle('past')} as median from p),
y as (select *, list_sort(list_transform(past, lambda v: abs(v - median))) as off from x),
z as (select *, {_middle('off')} as mad from y),
w as (select *, greatest(CAST({qt.TIMES * qt.SCALE!r} AS DOUBLE) * mad, CAST({qt.FLOOR!r} AS DOUBLE) * abs(median)) as width from z),
v as (select run, metric, "column", value, len(past) as n_before, median, mad, median - width as low, median + width as high from w)
select *, case when n_before < {qt.LEAST_RUNS} then 'unknown' when value is null or value < low or value > high then 'alarm' else 'ok' end as verdict,
  case when n_before < {qt.LEAST_RUNS} then 'too few runs before' when value is null then 'no value' when value < low then 'below the bound'
       when value > high then 'above the bound' else 'within bounds' end as reason from v"""

DQ_SPLIT_WRITE = """select l_orderkey, l_linenumber, l_quantity, l_discount,
  case when coalesce(l_discount <= CAST(0.08 AS DOUBLE) and l_quantity > 0, false) then 'valid' else 'rejected' end as side from lineitem"""

CATALOG_APPEND_MERGE = "select c_custkey, c_name, case when c_mktsegment = 'BUILDING' then null else c_mktsegment end as c_mktsegment from customer where c_mktsegment is not null"

CATALOG_DELETE = "select o_orderkey, o_orderstatus, o_totalprice from orders where not coalesce(o_orderstatus = 'F' and o_totalprice < 150000, false)"

ORACLE = {
    "ingest_by_header": INGEST_BY_HEADER,
    "ingest_incremental": INGEST_INCREMENTAL,
    "history_scd2_merge": HISTORY_SCD2,
    "history_merge": HISTORY_MERGE,
    "mart_delta": MART_DELTA,
    "mart_products": MART_PRODUCTS,
    "mart_segments": MART_SEGMENTS,
    "layout_zorder": LAYOUT_ZORDER,
    "layout_compaction": LAYOUT_COMPACTION,
    "dq_trend": DQ_TREND,
    "dq_split_write": DQ_SPLIT_WRITE,
    "catalog_append_merge": CATALOG_APPEND_MERGE,
    "catalog_delete": CATALOG_DELETE,
}
