"""The same results as plain SQL over the test tables, for checking in another engine."""

from __future__ import annotations

DOMAIN = """
with micro as (
  select concat(lpad(cast(s_nationkey as varchar),2,'0'), lpad(cast(l_suppkey as varchar),greatest(5,length(cast(l_suppkey as varchar)))::int,'0')) as territory_id,
         cast(year(l_shipdate) as int) as yr, l_returnflag as network, l_linestatus as grade,
         l_quantity as proficiency, cast(l_extendedprice as decimal(18,2)) as weight,
         cast(l_discount as decimal(9,2)) as disc, n_name as state
  from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey),
realized as (
  select territory_id, yr, network, grade,
         round(100 * cast(sum(case when proficiency >= 25 then weight else 0 end) as double)
               / nullif(cast(sum(weight) as double), 0), 1) as rate
  from micro group by territory_id, yr, network, grade),
g as (
  select territory_id, network,
         round(1000*cast(sum(case when yr=1996 then disc end) as double)/nullif(count(case when yr=1996 then 1 end),0),1) as t1996,
         round(1000*cast(sum(case when yr=1997 then disc end) as double)/nullif(count(case when yr=1997 then 1 end),0),1) as t1997,
         round(1000*cast(sum(case when yr=1998 then disc end) as double)/nullif(count(case when yr=1998 then 1 end),0),1) as t1998,
         round(1000*cast(sum(case when yr=1999 then disc end) as double)/nullif(count(case when yr=1999 then 1 end),0),1) as t1999,
         round(1000*cast(sum(case when yr=2000 then disc end) as double)/nullif(count(case when yr=2000 then 1 end),0),1) as t2000,
         round(1000*cast(sum(case when yr=2001 then disc end) as double)/nullif(count(case when yr=2001 then 1 end),0),1) as t2001
  from micro group by territory_id, network),
wide as (
  select territory_id, network, edition,
         round(t1996+edition-1995,1) as target_1996, round(t1997+edition-1995,1) as target_1997,
         case when right(territory_id,1)='0' then null else round(t1998+edition-1995,1) end as target_1998,
         round(t1999+edition-1995,1) as target_1999, round(t2000+edition-1995,1) as target_2000,
         round(t2001+edition-1995,1) as target_2001
  from g cross join (select 1995 as edition union all select 1996 as edition) e),
long as (
  select territory_id, network, edition, 1996 as target_year, target_1996 as target_value from wide where target_1996 is not null
  union all select territory_id, network, edition, 1997, target_1997 from wide where target_1997 is not null
  union all select territory_id, network, edition, 1998, target_1998 from wide where target_1998 is not null
  union all select territory_id, network, edition, 1999, target_1999 from wide where target_1999 is not null
  union all select territory_id, network, edition, 2000, target_2000 from wide where target_2000 is not null
  union all select territory_id, network, edition, 2001, target_2001 from wide where target_2001 is not null),
tgt as (
  select territory_id, network, target_year, target_value
  from (select *, row_number() over (partition by territory_id, network, target_year order by edition desc) as rn from long) x
  where rn = 1),
dict as (
  select * from (values ('lineitem','network','A','State'), ('lineitem','network',' N ','Municipal'),
                        ('other','network','A','Private')) as d(table_id, column_name, code, label))
"""

_RATES = """
select territory_id, yr, network,
       round(100*cast(sum(case when proficiency>=25 then weight else 0 end) as double)/nullif(cast(sum(weight) as double),0),1) as rate,
       cast(round(sum(weight),1) as double) as weight_total, count(*) as students
from {micro} where proficiency is not null {extra} group by territory_id, yr, network
"""

_EVOLUTION = """
select territory_id, network, yr as ref_year, rate as value, 'actual' as kind from realized
union all select territory_id, network, target_year, target_value, 'target' from tgt
"""

_COUNTED = "(select *, count(1) over (partition by l_orderkey, l_linenumber) as n from lineitem)"
_BAD = "n>1 or l_quantity<2 or l_quantity>49 or year(l_shipdate)<1996 or year(l_shipdate)>2000"
_REASON = """
concat_ws('; ', case when n>1 then 'duplicate_key' end,
    case when l_quantity<2 or l_quantity>49 then 'l_quantity_out_of_range' end,
    case when year(l_shipdate)<1996 or year(l_shipdate)>2000 then 'year_out_of_range' end)
"""

# Queries over the shared domain tables; a leading comma adds further ones.
_ON_DOMAIN = {
    "unpivot_targets": "select territory_id, network, edition, target_year, target_value from long",
    "state_from_prefix": """
select r.territory_id, r.yr, r.network, r.grade, n.n_name as state
from realized r left join nation n on cast(substring(r.territory_id,1,2) as int) = n.n_nationkey
""",
    "decode_network": """
select r.territory_id, r.yr, r.network, r.grade, r.rate, coalesce(d.label,'Not informed') as network_desc
from realized r left join (select trim(code) as code, min(label) as label from dict
  where column_name='network' and table_id='lineitem' group by trim(code)) d on r.network = d.code
""",
    "silver_results": """
select territory_id, yr, network, grade, rate,
       case network when 'A' then 'State' when 'N' then 'Municipal' else 'Não informado' end as network_desc,
       case grade when 'F' then 'First' else 'Não informado' end as grade_desc
from realized
""",
    "national_targets": """
select network, 1995 as edition, yr as target_year, round(1000*cast(sum(disc) as double)/count(*),1) as target_value
from micro where yr between 1996 and 2001 group by network, yr
""",
    "actual_with_trajectory": """
select r.territory_id, r.yr, r.network, r.grade, r.rate, l.target_year, l.target_value
from realized r left join long l on r.territory_id=l.territory_id and r.yr=l.edition and r.network=l.network
""",
    "target_vs_actual": """
select r.territory_id, r.yr, r.network, r.grade, r.rate, t.target_value,
       round(t.target_value - r.rate, 1) + 0.0e0 as gap_pp,
       case when t.target_value is not null then r.rate >= t.target_value end as attained
from realized r left join tgt t on r.territory_id=t.territory_id and r.yr=t.target_year and r.network=t.network
""",
    "gold_from_layers": """
, passed as (
  select territory_id, network, target_year, target_value
  from (select *, row_number() over (partition by territory_id, network, target_year order by edition desc) as rn
        from long where target_value between 0 and 100) x
  where rn = 1)
select r.territory_id, r.yr, r.network, r.grade, r.rate, t.target_value,
       round(t.target_value - r.rate, 1) + 0.0e0 as gap_pp,
       case when t.target_value is not null then r.rate >= t.target_value end as attained
from realized r left join passed t on r.territory_id=t.territory_id and r.yr=t.target_year and r.network=t.network
""",
    "latest_targets": "select territory_id, network, target_year, target_value from tgt",
    "state_target_vs_actual": """
, sr as (select state, yr, network, round(100*cast(sum(case when proficiency>=25 then weight else 0 end) as double)
        / nullif(cast(sum(weight) as double),0),1) as rate from micro group by state, yr, network),
  st as (select state, yr, round(1000*cast(sum(disc) as double)/count(*),1) as target_value from micro group by state, yr)
select sr.state, sr.yr, sr.network, sr.rate, st.target_value, round(st.target_value - sr.rate,1) + 0.0e0 as gap_pp
from sr left join st on sr.state=st.state and sr.yr=st.yr and sr.network='A'
""",
    "weighted_rate": _RATES.format(micro="micro", extra=""),
    "partitioned_layer": _RATES.format(micro="micro", extra="and yr = 1998"),
    "attainment_count": """
, f as (select case when t.target_value is not null then r.rate >= t.target_value end as attained
        from realized r join tgt t on r.territory_id=t.territory_id and r.yr=t.target_year and r.network=t.network where r.yr=1998)
select attained, count(*) as territories from f group by attained
""",
    "top_gap": """
select r.territory_id, r.network, r.grade, round(t.target_value - r.rate,1) + 0.0e0 as gap_pp
from realized r join tgt t on r.territory_id=t.territory_id and r.yr=t.target_year and r.network=t.network
where r.yr=1998 order by gap_pp desc, r.territory_id, r.network, r.grade limit 15
""",
    "evolution": _EVOLUTION,
    "ordered_sample": f"""
select * from ({_EVOLUTION}) s order by territory_id, kind, ref_year, network, value limit 20
""",
    "regional_inequality": """
select n.n_regionkey as region, r.yr, max(r.rate) as max_rate, min(r.rate) as min_rate, round(max(r.rate)-min(r.rate),1) as spread_pp
from realized r join nation n on cast(substring(r.territory_id,1,2) as int)=n.n_nationkey group by n.n_regionkey, r.yr
""",
    "rate_distribution": """
, x as (select n.n_regionkey as region, r.yr, r.rate,
               row_number() over (partition by n.n_regionkey, r.yr order by r.rate) as place,
               count(*) over (partition by n.n_regionkey, r.yr) as n
        from realized r join nation n on cast(substring(r.territory_id,1,2) as int)=n.n_nationkey where r.rate is not null)
select region, yr, max(n) as results,
       min(case when place*100 >= n*10 then rate end) as p10, min(case when place*100 >= n*50 then rate end) as p50,
       min(case when place*100 >= n*90 then rate end) as p90,
       round(cast(sum(cast(rate*10 as bigint)*(2*place - n - 1)) as double)
             / nullif(cast(max(n) as double) * cast(sum(cast(rate*10 as bigint)) as double), 0), 6) as gini
from x group by region, yr
""",
    "sketched_distribution": """
select n.n_regionkey as region, r.yr, count(*) as results, true as within_error
from realized r join nation n on cast(substring(r.territory_id,1,2) as int)=n.n_nationkey where r.rate is not null group by n.n_regionkey, r.yr
""",
    "regional_spread": """
select case substring(territory_id,1,1) when '1' then 'Norte' when '2' then 'Nordeste' end as region, yr, network,
       max(rate) as max_rate, min(rate) as min_rate, round(max(rate)-min(rate),1) as spread_pp
from realized group by 1, yr, network
""",
    "quality_report": """
, d as (select territory_id, max(cast(substring(territory_id,3) as int)) as supplier from micro group by territory_id),
checked as (select r.*, d.supplier % 5 <> 0 and (r.rate is null or r.rate between 10 and 60) as ok
            from realized r join d on r.territory_id = d.territory_id)
select 'municipio' as tbl, count(*) as total, count(*) filter (where ok) as approved, count(*) filter (where not ok) as quarantined,
       round(100 * cast(count(*) filter (where ok) as double) / count(*), 2) as pct_quality
from checked
""",
    "student_quarantine": """
, s as (select l_orderkey || '-' || l_linenumber as student_id, l_suppkey, l_quantity, year(l_shipdate) as yr,
               count(1) over (partition by l_orderkey, l_linenumber, year(l_shipdate)) as n from lineitem),
t as (select distinct territory_id, cast(substring(territory_id,3) as int) as supplier from micro)
select student_id, territory_id, cast(yr as int) as yr,
       concat_ws('; ', case when n > 1 then 'chave_duplicada' end,
                 case when l_quantity*25 > 1000 then 'proficiencia_fora_da_faixa' end,
                 case when yr + 28 not between 2019 and 2030 then 'ano_fora_da_faixa' end,
                 case when l_quantity = 7 then 'peso_aluno_fora_da_faixa' end) as reason
from s join t on s.l_suppkey = t.supplier
where n > 1 or l_quantity*25 > 1000 or yr + 28 not between 2019 and 2030 or l_quantity = 7
""",
    "table_versions": f"""
, r as ({_RATES.format(micro="micro", extra="")})
select cast(0 as int) as version, 6 as n_columns, yr, count(*) as n_rows from r group by yr
union all select cast(1 as int), 2, yr, count(*) from r where yr = 1998 group by yr
""",
    "trend_projection": """
, m as (select territory_id, network, grade, count(*) as n, cast(sum(yr-1995) as bigint) as sx,
        cast(sum((yr-1995)*(yr-1995)) as bigint) as sxx, cast(sum(cast(rate as decimal(26,10))) as double) as sy,
        cast(sum(cast(yr-1995 as decimal(5,0))*cast(rate as decimal(26,10))) as double) as sxy
        from realized where rate is not null group by territory_id, network, grade)
select territory_id, network, grade, n as years,
       round((round(1e10*sy)*(sxx-10*sx) + round(1e10*sxy)*(10*n-sx)) / (1e10*(n*sxx-sx*sx)), 1) + 0.0e0 as projected_2005
from m where n*sxx-sx*sx <> 0
""",
    "target_risk": f"""
, e as ({_EVOLUTION}),
  m as (select territory_id, network,
        count(case when kind='actual' then value end) as n,
        cast(sum(case when kind='actual' and value is not null then ref_year-1995 end) as bigint) as sx,
        cast(sum(case when kind='actual' and value is not null then (ref_year-1995)*(ref_year-1995) end) as bigint) as sxx,
        cast(sum(case when kind='actual' then cast(value as decimal(26,10)) end) as double) as sy,
        cast(sum(case when kind='actual' then cast(ref_year-1995 as decimal(5,0))*cast(value as decimal(26,10)) end) as double) as sxy,
        max(case when kind='target' and ref_year=2001 then value end) as target_2001
        from e group by territory_id, network),
  p as (select *, case when n*sxx-sx*sx <> 0 then
        round((round(1e10*sy)*(sxx-6*sx) + round(1e10*sxy)*(6*n-sx)) / (1e10*(n*sxx-sx*sx)), 1) + 0.0e0 end as projected_2001 from m)
select territory_id, network, n as years, projected_2001, target_2001,
       round(target_2001 - projected_2001, 1) + 0.0e0 as gap_pp, projected_2001 < target_2001 as at_risk
from p
""",
    "published_tables": """
select 'target_vs_actual' as tabela, count(*) as linhas from realized
union all select 'evolution', (select count(*) from realized) + (select count(*) from tgt)
""",
}

_STANDALONE = {
    "clean_keys": """
select lpad(cast(c_custkey as varchar),greatest(7,length(cast(c_custkey as varchar)))::int,'0') as territory_id, upper(trim(c_mktsegment)) as segment,
       cast(c_nationkey as int) as nation from customer
""",
    "fill_category": """
select d.doc_id, coalesce(cast(l.quality as varchar(9)),'Not informed') as quality
from documents d left join labels l on d.doc_id = l.doc_id
""",
    "stream_profile": """
select event_type, count(*) as events, round(cast(sum(cast(value as decimal(28,10))) as double)/count(*),1) as mean_value
from events group by event_type
""",
    "null_key_audit": """
select cast(sum(case when d.doc_id is null then 1 else 0 end) as bigint) as doc_id_null,
       cast(sum(case when l.quality is null then 1 else 0 end) as bigint) as quality_null
from documents d left join labels l on d.doc_id=l.doc_id
""",
    "row_counts": " union all ".join(
        f"select '{name}' as tabela, count(*) as linhas from {name}"
        for name in ("customer", "supplier", "orders", "lineitem", "events", "documents", "labels")
    ),
    "duplicate_count": f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, n as dup from {_COUNTED} x
""",
    "quarantine": f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, {_REASON} as reason
from {_COUNTED} x where {_BAD}
""",
    "indexed_duplicates": f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, n as dup from {_COUNTED} x
""",
    "indexed_quarantine": f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, {_REASON} as reason
from {_COUNTED} x where {_BAD}
""",
    "approved": f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, cast(year(l_shipdate) as int) as year
from {_COUNTED} x where not ({_BAD})
""",
    "quality_summary": f"""
with x as (select case when {_BAD} then 1 else 0 end as bad from {_COUNTED} y)
select 'lineitem' as tbl, count(*) as total, cast(sum(1-bad) as bigint) as approved, cast(sum(bad) as bigint) as quarantined,
       round(100.0e0*sum(1-bad)/count(*),2) as pct_quality from x
""",
    "reason_histogram": f"""
with x as (select concat_ws('; ', case when n>1 then 'duplicate_key' end,
    case when l_quantity<2 or l_quantity>49 then 'l_quantity_out_of_range' end) as reason
  from {_COUNTED} y where n>1 or l_quantity<2 or l_quantity>49)
select reason, count(*) as qty from x group by reason
""",
    "quarantine_sink": f"""
select reason, count(*) as qty from (select {_REASON} as reason from {_COUNTED} x where {_BAD}) y group by reason
""",
    "referential_violations": """
select d.doc_id from documents d where not exists (select 1 from labels l where l.doc_id=d.doc_id)
""",
    "null_key_quarantine": """
select doc_id, quality, concat_ws('; ', case when quality is null then 'null_key:quality' end,
       case when n > 1 then 'duplicate_key' end) as reason
from (select d.doc_id, l.quality, count(1) over (partition by l.quality) as n
      from documents d left join labels l on d.doc_id=l.doc_id) x
where quality is null or n > 1
""",
    "reference_quarantine": """
select d.doc_id, 'doc_id_unknown' as reason from documents d
where not exists (select 1 from labels l where l.doc_id=d.doc_id)
""",
    "rate_of_approved": f"""
with passed as (select * from {_COUNTED} x where not ({_BAD})),
micro as (
  select concat(lpad(cast(s_nationkey as varchar),2,'0'), lpad(cast(l_suppkey as varchar),greatest(5,length(cast(l_suppkey as varchar)))::int,'0')) as territory_id,
         cast(year(l_shipdate) as int) as yr, l_returnflag as network,
         l_quantity as proficiency, cast(l_extendedprice as decimal(18,2)) as weight
  from passed join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey)
{_RATES.format(micro="micro", extra="")}
""",
    "limited_scan": """
select 'orders' as tabela, count(*) as linhas from (select o_orderkey from orders limit 1000) x
""",
    "bronze_ingest": """
select o_orderkey, o_custkey, o_totalprice, o_orderdate, 'orders' as source, 'batch' as ingest_type from orders
""",
    "ingest_report": " union all ".join(
        f"select '{name}' as tabela, count(*) as linhas from {name}"
        for name in ("customer", "supplier", "lineitem")
    ),
    "stream_bronze": """
select event_id, user_id, ts, event_type, value, 'events' as source, 'streaming' as ingest_type from events
""",
    "stream_deduplicated": "select event_id, user_id, ts, event_type, value from events",
    "exact_rates": """
select l_returnflag as network, l_linestatus as grade,
       round(100*cast(sum(case when l_quantity>=25 then cast(l_extendedprice*l_discount/1e5 as decimal(28,10)) else 0 end) as double)
             / nullif(cast(sum(cast(l_extendedprice*l_discount/1e5 as decimal(28,10))) as double),0),1) as rate,
       round(cast(sum(cast(l_extendedprice*l_discount/1e5 as decimal(28,10))) as double),1) as weight_total, count(*) as students
from lineitem group by l_returnflag, l_linestatus
""",
    "events_without_id": """
with e as (select case when event_id % 10 <> 0 then event_id end as event_id, user_id, ts, value from events)
select * from e union all select * from e where event_id is null
""",
    "oversized_quarantine": """
select concat(c_custkey, '12345678') as territory_id, 'territory_id_longo_demais' as reason from customer where c_custkey % 7 = 0
""",
    "filtered_violations": """
select d.doc_id from documents d where not exists (select 1 from labels l where l.doc_id=d.doc_id)
""",
    "stable_sample": """
select event_id, user_id, ts, value from events
where ('0x' || substr(md5(cast(user_id as varchar)), 1, 15))::bigint < 115292150460684704
""",
    "stratified_sample": """
select event_id, event_type, value from (
  select *, row_number() over (partition by event_type
    order by ('0x' || substr(md5(cast(event_id as varchar)), 1, 15))::bigint, event_id) as place from events) x
where place <= 20
""",
    "live_deduplicated": "select event_id, user_id, ts, event_type, value from events",
    "live_latest": """
select event_id, user_id, ts, event_type, value
from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) x where rn=1
""",
    "live_alerts": """
select event_id, user_id, round(prev - value, 2) + 0.0e0 as drop_by
from (select *, lag(value) over (partition by user_id order by ts, event_id) as prev from events) x where prev - value > 100
""",
    "incremental_events": """
select cast(event_id as varchar) as event_id, lpad(cast(user_id as varchar), 7, '0') as territory_id,
       case when event_id % 5 = 0 then ts + interval 1 hour else ts end as ts,
       case when event_id % 5 = 0 then value + 1 else value end as value
from events
""",
    "latest_measurement": """
select event_id, user_id, ts, event_type, value
from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) x where rn=1
""",
    "drop_alert": """
select event_id, user_id, round(prev - value, 2) + 0.0e0 as drop_by
from (select *, lag(value) over (partition by user_id order by ts, event_id) as prev from events) x where prev - value > 100
""",
}

_ON_DOMAIN["lazy_gold"] = _ON_DOMAIN["target_vs_actual"]

SQL = {
    **{name: f"{DOMAIN}{text}" for name, text in _ON_DOMAIN.items()},
    **_STANDALONE,
}
