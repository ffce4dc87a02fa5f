"""Facility-shaped raw tables derived from the generic parquet tables.

Each view is plain SQL that Spark and DuckDB read alike; `{table}` stands for a
table of the data folder. No row is left out: ids and states that must not find
a partner are rewritten instead of filtered, so left joins miss some rows while
every input row is processed. Ids have twelve digits, enough for any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_ID = "lpad(cast({key} as string), 12, '0')"


def _facility(rating: str) -> str:
    return f"""
select case when c_custkey % 97 = 0 and c_custkey % 2 = 0 then '  '
            when c_custkey % 97 = 0 then cast(null as string)
            else {_ID.format(key='c_custkey')} end as provider_id,
       replace(upper(c_name), '#', ' ') || case when c_custkey % 5 = 0 then ' ST. MARY' || chr(39) || 'S-HOSPITAL'
            else ' medical CENTER' end as hospital_name,
       ' ' || cast(c_custkey as string) || ' Main ' as address,
       ' city_' || cast(c_custkey % 40 as string) || ' ' as city,
       ' ' || lower(n_name) as state,
       'Z' || cast(c_custkey * 37 as string) as zip_code,
       case c_mktsegment when 'HOUSEHOLD' then 'CRITICAL ACCESS HOSPITALS' when 'BUILDING' then 'acute care hospitals'
            when 'FURNITURE' then 'Psychiatric' when 'MACHINERY' then 'Childrens'
            else 'Rural Emergency Hospital' end as hospital_type,
       case c_nationkey % 5 when 0 then 'Government - State' when 1 then 'Proprietary'
            when 2 then 'Voluntary non-profit - Private' when 3 then 'Physician' else 'Tribal' end as hospital_ownership,
       case when c_custkey % 11 = 0 then 'Not Available' else cast({rating} as string) end as overall_rating
from {{customer}} join {{nation}} on c_nationkey = n_nationkey"""


VIEWS = {
    "hospitals_general": _facility("1 + c_custkey % 5"),
    "hospitals_general_2021": _facility("1 + (c_custkey * 3 + 1) % 5"),
    "hospitals_general_2022": _facility("1 + (c_custkey * 2 + 3) % 5"),
    "hospitals_readmissions": f"""
select case when o_custkey % 7 = 3 then 'closed-' else '' end || {_ID.format(key='o_custkey')} as provider_id,
       case substr(o_orderpriority, 1, 1) when '1' then 'READM-30-HF-HRRP' when '2' then 'READM-30-PN-HRRP'
            when '3' then 'READM-30-HIP-KNEE-HRRP' when '4' then 'READM-30-COPD-HRRP'
            else 'READM-30-AMI-HRRP' end as measure_id,
       o_orderpriority as measure_name,
       case when o_orderkey % 13 = 0 then 'N/A' when o_orderkey % 17 = 0 then 'Too Few to Report'
            else '1.' || lpad(cast(o_orderkey * 7919 % 1000 as string), 3, '0')
                 || case when o_orderkey % 5 = 0 then '%' else '' end end as score,
       case o_orderstatus when 'F' then 'Worse' when 'O' then 'Better' else 'No Different' end as compared_to_national
from {{orders}}""",
    "hospitals_patient_experience": f"""
select {_ID.format(key='user_id')} as provider_id,
       case event_type when 'click' then 'H_NURSE_LISTEN' when 'view' then 'H_DOCTOR_RESPECT'
            when 'signup' then 'H_RECOMMEND' when 'purchase' then 'H_CLEAN_HSP' else 'H_QUIET' end as measure_id,
       event_type as measure_name,
       case when event_id % 19 = 0 then 'Not Applicable' else cast(event_id % 101 as string) end as score
from {{events}}""",
    "hospitals_timely_care": f"""
select case when o_custkey % 9 = 4 then 'closed-' else '' end || {_ID.format(key='o_custkey')} as provider_id,
       case l_returnflag when 'A' then 'ED_2_Emergency' when 'N' then 'OP_23_CT' else 'SEP_1' end as measure_id,
       l_returnflag as measure_name,
       case when l_orderkey % 23 = 0 then 'Not Available'
            when o_custkey % 3 = 0 then cast(1 + l_linenumber % 5 as string)
            when o_custkey % 3 = 1 then cast(10 * l_linenumber as string)
            else cast(100 + 100 * l_linenumber as string) end as score
from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey""",
    "cdc_places_county": """
select cast(s_suppkey as string) as county_fips,
       case when n_nationkey = 24 then 'overseas' else lower(n_name) end as state,
       case p_type when 'STANDARD' then 'DIABETES' when 'PROMO' then 'OBESITY' when 'ECONOMY' then 'CSMOKING'
            when 'MEDIUM' then 'MHLTH' when 'SMALL' then 'ACCESS2' else 'LPA' end as measure_id,
       p_type as measure,
       case when l_orderkey % 29 = 0 then '' else cast(p_size as string) end as data_value
from {lineitem} join {part} on l_partkey = p_partkey join {supplier} on l_suppkey = s_suppkey
     join {nation} on s_nationkey = n_nationkey""",
}

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def raw(spark: SparkSession, folder: str, view: str) -> DataFrame:
    paths = {t: f"parquet.`{folder}/{t}.parquet`" for t in TABLES}
    return spark.sql(VIEWS[view].format(**paths))


def view_sql(view: str) -> str:
    """The same view over tables registered under their plain names."""
    return VIEWS[view].format(**{t: t for t in TABLES})
