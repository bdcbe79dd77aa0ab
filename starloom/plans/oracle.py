"""DuckDB oracle SQL for each registered query (test side only).

Each stand-in entity is a CTE mirroring ``starloom.plans.standins``; each
query mirrors the Spark builder it checks, column names included.
"""

from __future__ import annotations

from starloom.plans.sqlfrag import date_key as dk
from starloom.plans.sqlfrag import to_local as loc
from starloom.plans.sqlfrag import ts_default as tsd
from starloom.plans.sqlfrag import xxhash64_bigint as xx64
from starloom.plans.sqlfrag import xxhash64_int as xx32


def _code(e: str) -> str:
    return f"('C' || lpad(CAST({e} AS VARCHAR), 2, '0'))"


COSTCENTER = """select 'NATION_' || CAST(s_nationkey AS VARCHAR) as CostCenterNumber,
  case when s_nationkey % 5 = 0 then NULL else TIMESTAMP '2024-03-10 06:30:00' + to_hours(s_nationkey) end as LastProcessedChange_DateTime,
  TIMESTAMP '2024-01-01 02:00:00' + to_days(s_nationkey * 15) as DataLakeModified_DateTime,
  CAST(s_nationkey % 5 AS DOUBLE) / 20 as Vat,
  CAST(s_nationkey AS BIGINT) as RecordId
from (select distinct s_nationkey from supplier)"""

CURRENCY = f"""select cc as CurrencyId,
  case when cc >= 20 then ' ' || {_code('cc')} || ' ' else {_code('cc')} end as Code,
  case when cc % 5 = 1 then NULL else TIMESTAMP '2024-07-01 12:00:00' end as LastProcessedChange_DateTime,
  TIMESTAMP '2024-11-03 05:00:00' + to_hours(cc) as DataLakeModified_DateTime,
  ' NATION_' || CAST(cc AS VARCHAR) as Country,
  'Currency of NATION_' || CAST(cc AS VARCHAR) || ' ' as CurrencyName,
  CAST(cc + 1000 AS BIGINT) as RecordId
from (select distinct CAST(o_custkey % 25 AS INTEGER) as cc from orders)"""

PURCHASEORDER = f"""select l_orderkey as PoNumber, l_linenumber as LineItem, l_suppkey as VendId,
  case when l_linenumber = 1 then NULL else l_shipdate end as LastProcessedChange_DateTime,
  l_shipdate + INTERVAL 2 HOUR as DataLakeModified_DateTime,
  l_quantity as Qty, l_extendedprice / l_quantity as PurchasePrice, l_extendedprice as TotalOrder,
  'NATION_' || CAST(s_nationkey AS VARCHAR) as CostCenter,
  {_code('s_nationkey')} as CurrencyCode,
  CAST(1.0 AS DOUBLE) + CAST(s_nationkey AS DOUBLE) / 100 as ExchangeRate,
  l_partkey as Itemkey,
  l_shipdate - INTERVAL 10 DAY as OrderDate, l_shipdate as ShipDate,
  l_shipdate + INTERVAL 3 DAY as DeliveredDate,
  'TRK' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) as TrackingNumber,
  l_returnflag as Batchid, l_linestatus as CreatedBy, s_nationkey as CategoryId,
  l_orderkey * 10 + l_linenumber as RecordId
from lineitem join supplier on l_suppkey = s_suppkey"""

SALESORDERLINE = f"""select l_orderkey as SalesOrderNumber, l_linenumber as SalesOrderLine,
  case when l_linenumber = 2 then NULL else l_shipdate end as LastProcessedChange_DateTime,
  o_orderdate + INTERVAL 1 DAY as DataLakeModified_DateTime,
  l_partkey as ItemId, l_quantity as Qty, l_extendedprice / l_quantity as Price,
  l_tax as VatPercentage,
  {_code('(o_custkey % 25)')} as CurrencyCode,
  o_orderdate as BookDate, l_shipdate as ShippedDate, l_shipdate + INTERVAL 3 DAY as DeliveredDate,
  'TRK' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) as TrackingNumber,
  o_custkey as CustId, o_orderpriority as PaymentTypeDesc,
  l_orderkey * 10 + l_linenumber as RecordId
from lineitem join orders on l_orderkey = o_orderkey"""

PROMOTABLE = """select PromotionId, CAST(NULL AS TIMESTAMP) as LastProcessedChange_DateTime,
  TIMESTAMP '2024-01-31 20:00:00' + to_hours(p) as DataLakeModified_DateTime,
  PromotionName, ' P' || CAST(PromotionId AS VARCHAR) || ' ' as PromoCode,
  case when starts_with(PromotionName, 'Volume') then 'Volume' else 'Seasonal' end as PromoType,
  CAST(p + (y - 1995) * 5 AS DOUBLE) / 100 as PromoPercentage,
  vf as ValidFrom,
  case when y = 1996 and p = 5 then NULL when y = 1997 and p = 5 then vf - INTERVAL 3 DAY
       else vf + INTERVAL 8 DAY end as ValidTo,
  p <> 5 as IsActive, CAST(PromotionId + 500 AS BIGINT) as RecordId
from (select y, p, y * 10 + p as PromotionId, make_date(y, 1, p * 5)::TIMESTAMP as vf,
        case when y = 1995 and p = 1 then 'Volume Discount 11 to 20'
             when y = 1995 and p = 2 then 'Volume Discount 21 to 40'
             when y = 1995 and p = 3 then 'Volume Discount 41 to 60'
             when y = 1995 and p = 4 then 'Volume Discount > 60'
             else 'Seasonal Promotion ' || CAST(y AS VARCHAR) || '-' || CAST(p AS VARCHAR) end as PromotionName
      from (select distinct CAST(year(o_orderdate) AS INTEGER) as y,
                            CAST(substr(o_orderpriority, 1, 1) AS INTEGER) as p from orders))"""

FISCALPERIOD = """select CAST(year(m) * 100 + month(m) AS BIGINT) as RecordId,
  'FP' || strftime(m, '%Y%m') as FiscalPeriodName,
  m as FiscalStartDate, last_day(m) as FiscalEndDate,
  fm as FiscalMonth, make_date(fy - 1, 7, 1) as FiscalYearStart, make_date(fy, 6, 30) as FiscalYearEnd,
  fq as FiscalQuarter,
  CAST(make_date(fy - 1, 7, 1) + to_months((fq - 1) * 3) AS DATE) as FiscalQuarterStart,
  last_day(CAST(make_date(fy - 1, 7, 1) + to_months((fq - 1) * 3 + 2) AS DATE)) as FiscalQuarterEnd,
  fy as FiscalYear
from (select m, fy, fm, CAST((fm - 1) // 3 + 1 AS INTEGER) as fq from (
  select m, CAST(year(m) + case when month(m) >= 7 then 1 else 0 end AS INTEGER) as fy,
         CAST(case when month(m) >= 7 then month(m) - 6 else month(m) + 6 end AS INTEGER) as fm
  from (select distinct CAST(date_trunc('month', o_orderdate) AS DATE) as m from orders)))"""

VENDTABLE = f"""select s_suppkey as VendId, ' ' || s_name || ' ' as VendorName,
  CAST(NULL AS TIMESTAMP) as LastProcessedChange_DateTime,
  TIMESTAMP '2024-01-01 02:00:00' as DataLakeModified_DateTime,
  'Street ' || CAST(s_suppkey AS VARCHAR) as Address, ' City ' as City, 'ST' as State,
  case when s_nationkey = 0 then 'US' when s_nationkey = 1 then ' US ' when s_nationkey = 2 then 'USA'
       when s_nationkey = 3 then NULL else 'NATION_' || CAST(s_nationkey AS VARCHAR) end as Country,
  lpad(CAST(s_suppkey AS VARCHAR), 5, '0') as ZipCode, 'Region' as Region,
  TIMESTAMP '2020-01-01 00:00:00' as ValidFrom, CAST(NULL AS TIMESTAMP) as ValidTo,
  s_acctbal > 0 as Active, ' TAX' || CAST(s_suppkey AS VARCHAR) as TaxId,
  ' ' || {_code('s_nationkey')} || ' ' as CurrencyCode,
  s_suppkey + 100000 as RecordId
from supplier"""

WORKERTABLE = """select c_custkey as WorkerID, CAST(NULL AS TIMESTAMP) as LastProcessedChange_DateTime,
  TIMESTAMP '2024-07-15 05:00:00' as DataLakeModified_DateTime,
  CAST(c_nationkey AS BIGINT) as SupervisorId, ' ' || c_name as WorkerName,
  c_name || '@corp.example ' as WorkerEmail, ' 555-0100 ' as Phone,
  TIMESTAMP '2021-01-01 02:00:00' as DOJ, CAST(NULL AS TIMESTAMP) as DOL,
  case when c_nationkey < 5 then ' ' || c_mktsegment || ' ' else c_mktsegment end as Vertical,
  'FTE' as Type, c_acctbal as PayPerAnnum, c_acctbal / 2080 as Rate, c_custkey as RecordId
from customer"""


def _with(**ctes: str) -> str:
    return "with " + ",\n".join(f"{k} as ({v})" for k, v in ctes.items()) + "\n"


PURCHASE_FACT = _with(
    po=PURCHASEORDER,
    cc=f"select trim(CostCenterNumber) as ccn, Vat from ({COSTCENTER}) where RecordId is not null",
    cur=f"select trim(Code) as cc, CurrencyId from ({CURRENCY}) where CurrencyId is not null",
) + f"""select PoNumber, LineItem, VendId as VendorKey,
  {tsd('LastProcessedChange_DateTime')} as LastProcessedChange_DateTime,
  {loc('DataLakeModified_DateTime')} as DataLakeModified_DateTime,
  Qty, PurchasePrice, TotalOrder, CostCenter as CostCenterKey,
  Vat as VatRate, TotalOrder * Vat as VatAmount, round(TotalOrder + TotalOrder * Vat, 4) as TotalAmount,
  ExchangeRate, Itemkey, CurrencyId as CurrencyKey,
  {loc('OrderDate')} as OrderDate, {loc('ShipDate')} as ShipDate, {loc('DeliveredDate')} as DeliveredDate,
  {dk('OrderDate')} as OrderDateKey, {dk('ShipDate')} as ShipDateKey, {dk('DeliveredDate')} as DeliveredDateKey,
  TrackingNumber, Batchid as BatchId, CreatedBy, RecordId as PurchaseOrderRecordId, CategoryId as CategoryKey,
  {xx64('RecordId')} as PurchaseOrderHashKey
from po left join cc on trim(po.CostCenter) = cc.ccn left join cur on trim(po.CurrencyCode) = cur.cc
where po.RecordId is not null"""

CUSTTABLE = """select c_custkey as CustomerId,
  case when c_acctbal < 0 then NULL else TIMESTAMP '2024-11-03 06:30:00' end as LastProcessedChange_DateTime,
  TIMESTAMP '2024-01-01 02:00:00' as DataLakeModified_DateTime,
  '  ' || c_name || ' ' as CustomerName, lower(c_name) || '@mail.example' as Email,
  ' 555-0199' as Phone, 'Road ' || CAST(c_custkey AS VARCHAR) || ' ' as Address,
  'Town' as City, ' TX ' as State, 'NATION_' || CAST(c_nationkey AS VARCHAR) as Country,
  lpad(CAST(c_custkey AS VARCHAR), 6, '0') as ZipCode, ' ' || c_mktsegment as Region,
  TIMESTAMP '2020-01-01 00:00:00' + to_seconds(c_custkey * 3600) as SignupDate,
  c_custkey as RecordId
from customer"""

PARTIES = """select s_suppkey * 20 as PartyId, ' ' || s_name as PartyName,
  CAST(NULL AS TIMESTAMP) as LastProcessedChange_DateTime,
  TIMESTAMP '2024-03-10 08:00:00' as DataLakeModified_DateTime,
  s_nationkey as PartyAddressCode, TIMESTAMP '2010-07-01 02:00:00' as EstablishedDate,
  ' party' || CAST(s_suppkey AS VARCHAR) || '@mail.example' as PartyEmailId,
  '555-0000 ' as PartyContactNumber, 'TX' || CAST(s_suppkey AS VARCHAR) as TaxId,
  s_suppkey as RecordId
from supplier"""

PARTYADDRESS = """select c_custkey as PartyNumber, CAST(NULL AS TIMESTAMP) as LastProcessedChange_DateTime,
  TIMESTAMP '2024-01-01 02:00:00' as DataLakeModified_DateTime,
  ' Main ' || CAST(c_custkey AS VARCHAR) as Address, ' City' as City, 'ST' as State,
  'NATION_' || CAST(c_nationkey AS VARCHAR) as Country, '00000' as ZipCode, 'R' as Region,
  TIMESTAMP '2019-01-01 00:00:00' as ValidFrom, CAST(NULL AS TIMESTAMP) as ValidTo,
  c_custkey * 2 as RecordId
from customer
union all
select c_custkey, TIMESTAMP '2024-07-04 12:00:00', TIMESTAMP '2024-07-04 12:00:00',
  ' Billing ' || CAST(c_custkey AS VARCHAR), ' City', 'ST',
  'NATION_' || CAST(c_nationkey AS VARCHAR), '11111', 'R',
  TIMESTAMP '2022-01-01 00:00:00', TIMESTAMP '2030-01-01 00:00:00', c_custkey * 2 + 1
from customer where c_acctbal > 5000"""

BANDS = """case PromotionName when 'Volume Discount 11 to 20' then 11 when 'Volume Discount 21 to 40' then 21
    when 'Volume Discount 41 to 60' then 41 when 'Volume Discount > 60' then 61 else NULL end as VolumeStart,
  case PromotionName when 'Volume Discount 11 to 20' then 20 when 'Volume Discount 21 to 40' then 40
    when 'Volume Discount 41 to 60' then 60 when 'Volume Discount > 60' then 9999999 else NULL end as VolumeEnd"""

PAYMENT_TYPES = """select CAST(row_number() over (order by PaymentTypeDesc) AS INTEGER) as PaymentTypeId, PaymentTypeDesc
from (select distinct o_orderpriority as PaymentTypeDesc from orders where o_orderpriority is not null)"""

VERTICALS = f"""select CAST(row_number() over (order by Vertical) AS BIGINT) as VerticalId, Vertical
from (select distinct trim(Vertical) as Vertical from ({WORKERTABLE}) where trim(Vertical) is not null)"""

SALES_FACT = _with(
    sol=SALESORDERLINE, cur=CURRENCY, pt=PAYMENT_TYPES,
    pr=f"select PromotionId, {BANDS}, ValidFrom, ValidTo, PromoPercentage from ({PROMOTABLE})",
    j="""select S.*, C.CurrencyId, P.PaymentTypeId, PR.PromotionId, PR.PromoPercentage
  from sol S left join cur C on S.CurrencyCode = C.Code
  left join pt P on S.PaymentTypeDesc = P.PaymentTypeDesc
  left join pr PR on case when month(S.BookDate) = 1 then S.BookDate between PR.ValidFrom and PR.ValidTo
                          else S.Qty between PR.VolumeStart and PR.VolumeEnd end
  where S.RecordId is not null""",
    a="""select *, Qty * Price as TotalAmount from j""",
    b="""select *, case when PromotionId is null then TotalAmount else TotalAmount * (1 - PromoPercentage) end
  as TotalAmountWithDiscount from a""",
    c="""select *, TotalAmountWithDiscount * VatPercentage as VatAmount from b""",
) + f"""select SalesOrderNumber, SalesOrderLine,
  {tsd('LastProcessedChange_DateTime')} as LastProcessedChange_DateTime,
  {loc('DataLakeModified_DateTime')} as DataLakeModified_DateTime,
  ItemId, Qty, Price, TotalAmount, TotalAmountWithDiscount, VatPercentage, VatAmount,
  TotalAmountWithDiscount + VatAmount as TotalOrderAmount, CurrencyId,
  {loc('BookDate')} as BookDate, {dk('BookDate')} as BookDateKey,
  {loc('ShippedDate')} as ShippedDate, {dk('ShippedDate')} as ShippedDateKey,
  {loc('DeliveredDate')} as DeliveredDate, {dk('DeliveredDate')} as DeliveredDateKey,
  TrackingNumber, CustId, PaymentTypeId, PromotionId,
  RecordId as SalesOrderLineRecordId, {xx64('RecordId')} as SalesOrderLineHashKey
from c"""

STD = f"""{tsd('LastProcessedChange_DateTime')} as LastProcessedChange_DateTime,
  {loc('DataLakeModified_DateTime')} as DataLakeModified_DateTime"""

DIM_COSTCENTER = f"""select trim(CostCenterNumber) as CostCenterNumber, {STD}, Vat,
  RecordId as CostCenterRecordId, {xx64('RecordId')} as CostCenterHashKey
from ({COSTCENTER}) where RecordId is not null"""

DIM_CURRENCY = f"""select CurrencyId, trim(Code) as CurrencyCode, {STD}, trim(Country) as Country,
  trim(CurrencyName) as CurrencyName, RecordId as CurrencyRecordId, {xx64('RecordId')} as CurrencyHashKey
from ({CURRENCY}) where CurrencyId is not null"""

DIM_CUSTOMER = f"""select CustomerId, {STD}, trim(CustomerName) as CustomerName, trim(Email) as Email,
  trim(Phone) as Phone, trim(Address) as Address, trim(City) as City, trim(State) as State,
  trim(Country) as Country, trim(ZipCode) as ZipCode, trim(Region) as Region,
  {loc('SignupDate')} as SignupDate, RecordId as CustRecordId, {xx64('RecordId')} as CustHashKey
from ({CUSTTABLE}) where RecordId is not null"""

DIM_PROMOTION = f"""select PromotionId, {STD}, trim(PromotionName) as PromotionName,
  trim(PromoCode) as PromoCode, trim(PromoType) as PromoType, PromoPercentage,
  {loc('ValidFrom')} as ValidFrom, {loc('ValidTo')} as ValidTo, IsActive,
  RecordId as PromoRecordId, {xx64('RecordId')} as PromoHashKey
from ({PROMOTABLE}) where RecordId is not null"""

DIM_VENDOR = f"""select VendId as VendorId, trim(VendorName) as VendorName,
  {tsd('LastProcessedChange_DateTime')} as vendTableLastProcessedChange_DateTime,
  {loc('DataLakeModified_DateTime')} as DataLakeModified_DateTime,
  trim(Address) as Address, trim(City) as City, trim(State) as State, trim(Country) as Country,
  trim(ZipCode) as ZipCode, trim(Region) as Region, {loc('ValidFrom')} as ValidFrom,
  {loc('ValidTo')} as ValidTo, Active, RecordId as VendorRecordId, trim(TaxId) as TaxId,
  trim(CurrencyCode) as CurrencyCode, {xx64('RecordId')} as VendorHashKey,
  case when trim(Country) = 'US' then CAST(0.01 AS DOUBLE) else CAST(0.0 AS DOUBLE) end as VendorDiscount
from ({VENDTABLE}) where VendId is not null"""

_PURCH_N = "CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER)"
DIM_PURCHASE_CATEGORY = f"""select n as CategoryId, trim('  ' || p_brand || ' ') as CategoryName,
  {tsd("case when n % 3 = 0 then NULL else TIMESTAMP '2024-07-01 12:00:00' end")} as LastProcessedChange_DateTime,
  {loc("TIMESTAMP '2024-11-03 05:00:00'")} as DataLakeModified_DateTime,
  CAST(n // 10 AS INTEGER) as CategoryGroupId, CAST(n + 500 AS BIGINT) as PurchCategoryRecordId,
  {xx64('CAST(n + 500 AS BIGINT)')} as PurchCategoryHashKey
from (select distinct p_brand, {_PURCH_N} as n from part where p_brand is not null) where n % 10 <> 5"""

DIM_PURCH_ITEM = f"""select p_partkey as ItemId, trim(' ' || p_name || '  ') as ProductName,
  {tsd("case when p_partkey % 4 = 0 then NULL else TIMESTAMP '2024-01-15 00:30:00' end")} as LastProcessedChange_DateTime,
  {loc("TIMESTAMP '2024-03-10 09:00:00'")} as DataLakeModified_DateTime,
  {loc("TIMESTAMP '2020-01-01 00:00:00'")} as ValidFrom,
  {loc("case when p_partkey % 7 <> 0 then TIMESTAMP '2030-07-01 00:00:00' end")} as ValidTo,
  p_retailprice as ProductPerUnitCost, p_partkey * 10 as PurchItemRecordId, {_PURCH_N} as CategoryID,
  {xx64('p_partkey * 10')} as PurchItemHashKey
from part where p_partkey % 11 <> 0"""

DIM_PARTY = _with(p=f"select * from ({PARTIES}) where RecordId is not null", a=PARTYADDRESS) + f"""
select p.PartyId, trim(p.PartyName) as PartyName,
  {tsd('p.LastProcessedChange_DateTime')} as PartiesLastProcessedChange_DateTime,
  {loc('p.DataLakeModified_DateTime')} as PartiesDataLakeModified_DateTime,
  p.PartyAddressCode, {loc('p.EstablishedDate')} as EstablishedDate,
  trim(p.PartyEmailId) as PartyEmailId, trim(p.PartyContactNumber) as PartyContactNumber,
  p.RecordId as PartyRecordId, trim(p.TaxId) as TaxId, a.PartyNumber,
  {tsd('a.LastProcessedChange_DateTime')} as PartyAddressLastProcessedChange_DateTime,
  {loc('a.DataLakeModified_DateTime')} as PartyAddressDataLakeModified_DateTime,
  trim(a.Address) as Address, trim(a.City) as City, trim(a.State) as State,
  trim(a.Country) as Country, trim(a.ZipCode) as ZipCode, trim(a.Region) as Region,
  {loc('a.ValidFrom')} as ValidFrom, {tsd('a.ValidTo')} as ValidTo,
  a.RecordId as PartyAddressRecordId, {xx64('p.RecordId')} as PartyHashKey
from p left join a on p.PartyId = a.PartyNumber"""

DIM_WORKER = _with(w=f"select * from ({WORKERTABLE}) where RecordId is not null", v=VERTICALS) + f"""
select WorkerID, {STD}, SupervisorId, trim(WorkerName) as WorkerName, trim(WorkerEmail) as WorkerEmail,
  trim(Phone) as Phone, {loc('DOJ')} as DOJ, {loc('DOL')} as DOL, v.VerticalId, Type,
  PayPerAnnum, Rate, RecordId as WorkerRecordId, {xx64('RecordId')} as WorkerHashKey
from w left join v on trim(w.Vertical) = v.Vertical"""

DIM_PAYMENT_TYPES = """with src as (
  select o_orderpriority || ' ' || CAST(year(o_orderdate) AS VARCHAR) as PaymentTypeDesc, o_orderdate from orders),
first as (
  select CAST(row_number() over (order by PaymentTypeDesc) AS INTEGER) as PaymentTypeId, PaymentTypeDesc
  from (select distinct PaymentTypeDesc from src
        where o_orderdate < TIMESTAMP '1998-01-01' and PaymentTypeDesc is not null)),
fresh as (
  select PaymentTypeDesc from (select distinct PaymentTypeDesc from src where PaymentTypeDesc is not null)
  where PaymentTypeDesc not in (select PaymentTypeDesc from first))
select PaymentTypeId, PaymentTypeDesc from first
union all
select CAST(row_number() over (order by PaymentTypeDesc) + (select coalesce(max(PaymentTypeId), 0) from first)
  AS INTEGER), PaymentTypeDesc from fresh"""

DIM_PAYMENT_TYPES_WITH_NULL = """with src as (
  select case when o_orderpriority <> '5-LOW' then o_orderpriority end as PaymentTypeDesc from orders),
first as (
  select CAST(row_number() over (order by PaymentTypeDesc NULLS FIRST) AS INTEGER) as PaymentTypeId,
         PaymentTypeDesc
  from (select distinct PaymentTypeDesc from src)),
fresh as (
  select PaymentTypeDesc from (select distinct PaymentTypeDesc from src) s
  where not exists (select 1 from first f where f.PaymentTypeDesc is not distinct from s.PaymentTypeDesc))
select PaymentTypeId, PaymentTypeDesc from first
union all
select CAST(row_number() over (order by PaymentTypeDesc NULLS FIRST)
            + (select coalesce(max(PaymentTypeId), 0) from first) AS INTEGER), PaymentTypeDesc from fresh"""

CALENDAR = """select CAST(d AS TIMESTAMP) as Date from (
  select unnest(generate_series(make_date(lo, 1, 1)::TIMESTAMP, make_date(hi, 12, 31)::TIMESTAMP, INTERVAL 1 DAY)) as d
  from (select CAST(year(min(o_orderdate)) AS INTEGER) lo, CAST(year(max(o_orderdate)) AS INTEGER) hi from orders))"""

FISCAL_COLS = ("FiscalStartDate, FiscalEndDate, FiscalMonth, FiscalYearStart, FiscalYearEnd, "
               "FiscalQuarter, FiscalQuarterStart, FiscalQuarterEnd")

DIM_DATE = _with(cal=CALENDAR, fp=f"select * from ({FISCALPERIOD}) where RecordId is not null") + f"""
select Date, {dk('Date')} as DateId, CAST(year(Date) AS INTEGER) as Year, CAST(month(Date) AS INTEGER) as Month,
  strftime(Date, '%b') as MonthName, CAST(day(Date) AS INTEGER) as Day, strftime(Date, '%a') as DayName,
  CAST(quarter(Date) AS INTEGER) as Quarter, FiscalPeriodName, {FISCAL_COLS},
  'FY' || CAST(FiscalYear AS VARCHAR) as FiscalYear, {xx32(dk('Date'))} as DateKey
from cal left join fp on cal.Date >= fp.FiscalStartDate and cal.Date <= fp.FiscalEndDate"""

FISCAL_RANGE_JOIN = _with(fp=FISCALPERIOD) + """
select l_orderkey, l_linenumber, l_shipdate, FiscalPeriodName, FiscalStartDate, FiscalEndDate,
  FiscalYear, FiscalQuarter, FiscalMonth
from lineitem left join fp on l_shipdate >= fp.FiscalStartDate and l_shipdate <= fp.FiscalEndDate"""

MART_SALES_BY_FISCAL_PERIOD = _with(f=SALES_FACT, d=DIM_DATE) + """
select FiscalYear, FiscalQuarter, CAST(sum(lines) AS BIGINT) as line_count, sum(qty) as total_qty,
  CAST(sum(amount) AS DOUBLE) as net_sales, CAST(sum(promoted) AS BIGINT) as promoted_lines,
  grouping(FiscalYear, FiscalQuarter) as grouping_level
from (select BookDateKey, count(*) as lines, sum(Qty) as qty,
             sum(CAST(TotalOrderAmount AS DECIMAL(38,10))) as amount, count(PromotionId) as promoted
      from f group by BookDateKey) p
left join d on p.BookDateKey = d.DateId
group by rollup (FiscalYear, FiscalQuarter)"""

MART_PURCHASES_BY_VENDOR_COUNTRY = _with(f=PURCHASE_FACT, v=DIM_VENDOR) + """
select Country, VendorDiscount, count(distinct VendorKey) as vendors, CAST(sum(lines) AS BIGINT) as line_count,
  CAST(sum(spend) AS DOUBLE) as spend, CAST(sum(spend_with_vat) AS DOUBLE) as spend_with_vat,
  CAST(sum(spend) AS DOUBLE) * VendorDiscount as discount_value
from (select VendorKey, count(*) as lines, sum(CAST(TotalOrder AS DECIMAL(38,10))) as spend,
             sum(CAST(TotalAmount AS DECIMAL(38,10))) as spend_with_vat
      from f group by VendorKey) p
left join v on p.VendorKey = v.VendorId
group by Country, VendorDiscount"""

ORACLE: dict[str, str] = {
    "mart_sales_by_fiscal_period": MART_SALES_BY_FISCAL_PERIOD,
    "mart_purchases_by_vendor_country": MART_PURCHASES_BY_VENDOR_COUNTRY,
    "purchase_fact": PURCHASE_FACT,
    "sales_fact": SALES_FACT,
    "dim_costcenter": DIM_COSTCENTER,
    "dim_currency": DIM_CURRENCY,
    "dim_customer": DIM_CUSTOMER,
    "dim_promotion": DIM_PROMOTION,
    "dim_vendor": DIM_VENDOR,
    "dim_purchase_category": DIM_PURCHASE_CATEGORY,
    "dim_purch_item": DIM_PURCH_ITEM,
    "dim_party": DIM_PARTY,
    "dim_vertical": VERTICALS,
    "dim_worker": DIM_WORKER,
    "dim_payment_types": DIM_PAYMENT_TYPES,
    "dim_payment_types_with_null": DIM_PAYMENT_TYPES_WITH_NULL,
    "dim_date": DIM_DATE,
    "fiscal_range_join": FISCAL_RANGE_JOIN,
}

LINEITEM_COLS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")

CONFORM_TIMESTAMPS = f"""select event_id,
  {tsd("case when event_type = 'error' then NULL else ts end")} as LastProcessedChange_DateTime,
  {loc('ts')} as LocalTime, CAST({loc('ts')} AS DATE) as LocalDate,
  {dk('ts')} as EventDateKey, {dk(loc('ts'))} as LocalDateKey
from events"""

HASH_KEYS = f"""select o_orderkey, {xx64('o_orderkey')} as OrderHashKey, {dk('o_orderdate')} as OrderDateId,
  {xx32(dk('o_orderdate'))} as OrderDateHashKey from orders"""

DQ_RECORD_COUNTS = f"""select 'lineitem_to_factpurchaseorder' as "check", s as source_rows, t as target_rows, s = t as passed
from (select (select count(*) from lineitem) as s,
             (select count(*) from ({PURCHASEORDER}) where RecordId is not null) as t)"""

DQ_DUPLICATES = """select l_orderkey, l_linenumber, count(*) as dup_count from lineitem
group by l_orderkey, l_linenumber having count(*) > 1"""

GAPS = """(select * replace (case when l_linenumber = 1 then null else l_discount end as l_discount,
  case when l_returnflag = 'R' then null else l_shipdate end as l_shipdate) from lineitem)"""

DQ_NULL_COUNTS = "select count(*) as total_rows, " + ", ".join(
    f"CAST(count_if({c} is null) AS BIGINT) as null_{c}" for c in LINEITEM_COLS) + f" from {GAPS}"


def _key_validity(table: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    anynull = " or ".join(f"{c} is null" for c in keys)
    return f"""select CAST(sum(n) AS BIGINT) as total_rows,
  CAST(sum(case when has_null = 1 then n else 0 end) AS BIGINT) as null_key_rows,
  CAST(count_if(n > 1 and has_null = 0) AS BIGINT) as duplicate_keys,
  CAST(count_if(has_null = 0) AS BIGINT) as distinct_keys,
  sum(case when has_null = 1 then n else 0 end) = 0 and count_if(n > 1 and has_null = 0) = 0 as passed,
  '{table}' as table_name
from (select {k}, count(*) as n, max(case when {anynull} then 1 else 0 end) as has_null
      from {table} group by {k})"""


DQ_KEY_VALIDITY = _key_validity("orders", ["o_orderkey"]) + "\nunion all\n" + _key_validity(
    "lineitem", ["l_orderkey", "l_linenumber"])


def _orphans(name: str, fact: str, fk: str, dim: str, dk_: str) -> str:
    return (f"select '{name}' as \"check\", count(*) as orphan_rows from {fact} f where f.{fk} is not null "
            f"and not exists (select 1 from {dim} d where d.{dk_} = f.{fk})")


DQ_ORPHANS = "\nunion all\n".join([
    _orphans("lineitem.l_orderkey->orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    _orphans("lineitem.l_partkey->part", "lineitem", "l_partkey", "part", "p_partkey"),
    _orphans("lineitem.l_suppkey->supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    _orphans("orders.o_custkey->customer", "orders", "o_custkey", "customer", "c_custkey"),
    _orphans("lineitem.l_orderkey->some orders", "lineitem", "l_orderkey",
             "(select * from orders where o_orderstatus <> 'F')", "o_orderkey"),
    _orphans("orders.o_custkey->some customers", "orders", "o_custkey",
             "(select * from customer where c_mktsegment <> 'BUILDING')", "c_custkey"),
])

DQ_QUARANTINE = """select l_orderkey, l_linenumber, l_quantity, l_discount from lineitem
where not coalesce(l_discount <= CAST(0.08 AS DOUBLE) and l_quantity > 0, false)"""

ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

DQ_KEEP_LATEST = f"""select {ORDERS_COLS} from (select *, row_number() over
  (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn from orders) where rn = 1"""


def _rule(name, table, kind, failed, total, src):
    return (f"select '{name}' as rule, '{table}' as table_name, '{kind}' as kind, "
            f"CAST({failed} AS BIGINT) as failed_rows, CAST({total} AS BIGINT) as total_rows, "
            f"CAST({failed} AS BIGINT) = 0 as passed from {src}")


_DUP = "coalesce(sum(case when n > 1 then n end), 0)"
DQ_RULES = "\nunion all\n".join([
    _rule("orders_key_not_null", "orders", "not_null", "count_if(o_orderkey is null)", "count(*)", "orders"),
    _rule("orders_key_unique", "orders", "unique", _DUP, "coalesce(sum(n), 0)",
          "(select o_orderkey, count(*) as n from orders group by o_orderkey)"),
    _rule("lineitem_key_unique", "lineitem", "unique", _DUP, "coalesce(sum(n), 0)",
          "(select l_orderkey, l_linenumber, count(*) as n from lineitem group by l_orderkey, l_linenumber)"),
    _rule("lineitem_discount_range", "lineitem", "valid",
          "count_if(not coalesce(l_discount between 0 and 0.1, false))", "count(*)", "lineitem"),
    _rule("lineitem_order_fk", "lineitem", "foreign_key",
          "count_if(l_orderkey is not null and not exists (select 1 from orders o where o.o_orderkey = l.l_orderkey))",
          "count(*)", "lineitem l"),
    _rule("customer_not_empty", "customer", "row_count",
          "case when count(*) < 1 then 1 else 0 end", "count(*)", "customer"),
    _rule("gaps_discount_not_null", "gaps", "not_null", "count_if(l_discount is null or l_shipdate is null)", "count(*)", GAPS),
    _rule("lineitem_order_unique", "lineitem", "unique", _DUP, "coalesce(sum(n), 0)",
          "(select l_orderkey, count(*) as n from lineitem group by l_orderkey)"),
    _rule("lineitem_small_discount", "lineitem", "valid",
          "count_if(not coalesce(l_discount <= CAST(0.05 AS DOUBLE), false))", "count(*)", "lineitem"),
    _rule("lineitem_some_orders_fk", "lineitem", "foreign_key",
          "count_if(l_orderkey is not null and not exists (select 1 from orders o where o.o_orderkey = l.l_orderkey and o.o_orderstatus <> 'F'))",
          "count(*)", "lineitem l"),
    _rule("customer_many", "customer", "row_count",
          "case when count(*) < 1000000000 then 1 else 0 end", "count(*)", "customer"),
])

NET_REV = "CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2)))"

MART_REVENUE_ROLLUP = f"""select CAST(year(o_orderdate) AS INTEGER) as order_year,
  CAST(quarter(o_orderdate) AS INTEGER) as order_quarter,
  CAST(sum({NET_REV}) AS DOUBLE) as net_revenue, count(*) as line_count,
  grouping(CAST(year(o_orderdate) AS INTEGER), CAST(quarter(o_orderdate) AS INTEGER)) as grouping_level
from lineitem join orders on l_orderkey = o_orderkey
group by rollup (CAST(year(o_orderdate) AS INTEGER), CAST(quarter(o_orderdate) AS INTEGER))"""

MART_VENDOR_PERFORMANCE = f"""select s_suppkey, s_name, n_name, CAST(year(l_shipdate) AS INTEGER) as ship_year,
  count(*) as line_count,
  CAST(sum(CAST(l_quantity AS DECIMAL(15,2))) AS DOUBLE) as total_qty,
  CAST(sum({NET_REV}) AS DOUBLE) as net_revenue,
  CAST(sum(CAST(l_discount AS DECIMAL(15,2))) AS DOUBLE) / count(*) as avg_discount,
  CAST(count_if(l_returnflag = 'R') AS DOUBLE) / count(*) as return_rate
from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
group by s_suppkey, s_name, n_name, CAST(year(l_shipdate) AS INTEGER)"""

MART_TOP_CUSTOMERS = f"""with pc as (select o_custkey, sum({NET_REV}) as rev, count(distinct o_orderkey) as order_count
  from lineitem join orders on l_orderkey = o_orderkey group by o_custkey),
top as (select * from pc order by rev desc, o_custkey asc limit 20)
select o_custkey as customer_key, c_name, c_mktsegment, CAST(rev AS DOUBLE) as net_revenue, order_count
from top left join customer on o_custkey = c_custkey"""

EV = "select event_id, ts, user_id, event_type, value from events"


def _latest(where: str) -> str:
    return (f"select event_id, ts, user_id, event_type, value from (select *, row_number() over "
            f"(partition by user_id order by ts desc, event_id desc) as rn from ({EV}) {where}) where rn = 1")


HISTORY_SCD2 = """with p as (select user_id, ts, event_id, event_type,
    lag(event_type) over (partition by user_id order by ts, event_id) as pt,
    lag(1) over (partition by user_id order by ts, event_id) as hp from events),
s as (select user_id, ts, event_id, event_type from p where hp is null or pt is distinct from event_type)
select user_id, event_type, ts as ValidFrom,
  lead(ts) over (partition by user_id order by ts, event_id) as ValidTo,
  lead(ts) over (partition by user_id order by ts, event_id) is null as IsCurrent
from s"""

CUT = "TIMESTAMP '2024-01-15 00:00:00'"

HISTORY_SNAPSHOT_CHANGES = _with(
    l=_latest(f"where ts < {CUT}"), b="select * from l where event_type <> 'signup'", e=_latest(""), v="select * from l where event_type = 'view'",
    a="select * from e where event_type <> 'error' and user_id not in (select user_id from v) union all select * from v") + """
select coalesce(b.user_id, a.user_id) as user_id,
  case when a.user_id is null then 'delete' when b.user_id is null then 'insert' else 'update' end as change
from b full outer join a on b.user_id = a.user_id
where a.user_id is null or b.user_id is null
   or a.event_type is distinct from b.event_type or a.value is distinct from b.value"""

HISTORY_UPSERT = _with(tgt=_latest(f"where ts < {CUT}"), upd=_latest(f"where ts >= {CUT}")) + """
select * from upd union all select * from tgt where user_id not in (select user_id from upd)"""

INCREMENTAL_WATERMARK = _latest("where ts > TIMESTAMP '2024-01-20 00:00:00'")

ORACLE.update({
    "conform_timestamps": CONFORM_TIMESTAMPS,
    "hash_keys": HASH_KEYS,
    "dq_record_counts": DQ_RECORD_COUNTS,
    "dq_duplicates": DQ_DUPLICATES,
    "dq_null_counts": DQ_NULL_COUNTS,
    "dq_key_validity": DQ_KEY_VALIDITY,
    "dq_orphans": DQ_ORPHANS,
    "dq_quarantine": DQ_QUARANTINE,
    "dq_keep_latest": DQ_KEEP_LATEST,
    "dq_rules": DQ_RULES,
    "mart_revenue_rollup": MART_REVENUE_ROLLUP,
    "mart_vendor_performance": MART_VENDOR_PERFORMANCE,
    "mart_top_customers": MART_TOP_CUSTOMERS,
    "history_scd2": HISTORY_SCD2,
    "history_snapshot_changes": HISTORY_SNAPSHOT_CHANGES,
    "history_upsert": HISTORY_UPSERT,
    "incremental_watermark": INCREMENTAL_WATERMARK,
})
