"""Stand-ins: the source tables, derived from the TPC-H-like test tables.

Each is one SELECT that Spark and a SQL checker both accept, with the test tables in braces, so
that both start from the same input. Only inputs are shared; every operator is written twice.
Codes are derived from keys to reach all branches; every trip of nations 19 and 20, one sector, is
observed. No row of a test table is left out, except
that only orders of status F have an observer on board.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import LandingTables, ObserverTables
from ..sources.zones import zones_from_vertices

YEARS = (1995, 2001)
ALL_AREAS = list(range(198, 208))

# fleet description code of each nation (None: no fleet)
NATION_FLEETS = [
    881, 881, 881, 3328, 3328, 311, 1523, 311, 885, 1472, 885, 90, 91, 8976, 9318, 89, 9317, 884, 6875, 886, 1817,
    12305, 10865, 999, None,
]
# every code of the sector list, one unknown code and one null, for the code-list query
ALL_FLEETS = [
    90, 91, 92, 93, 94, 95, 8976, 8977, 9318, 9319, 10865, 10866, 12305, 12195, 89, 9317, 881, 884, 6875, 885, 1472,
    886, 1817, 311, 1523, 3328, 999, None,
]

# (zone_id, ring_id, [(lon, lat), ...]); zone 0 is "no valid zone", zone 5 has a hole
ZONE_RINGS = [
    (1, 1, [(-69.01371, 39.90113), (-67.01307, 39.90113), (-67.01307, 41.50713), (-69.01371, 41.50713)]),
    (2, 1, [(-67.01307, 39.90113), (-65.51019, 39.90113), (-65.51019, 41.50713), (-67.01307, 41.50713)]),
    (3, 1, [(-69.01371, 41.50713), (-67.01307, 41.50713), (-67.90417, 43.20511)]),
    (4, 1, [(-67.01307, 41.50713), (-65.51019, 41.50713), (-65.30211, 42.80317), (-66.60353, 43.10119)]),
    (5, 1, [(-65.51019, 39.90113), (-64.00231, 39.90113), (-64.00231, 41.10127), (-65.51019, 41.10127)]),
    (5, 2, [(-65.20113, 40.20119), (-64.70231, 40.20119), (-64.70231, 40.70127), (-65.20113, 40.70127)]),
    (0, 1, [(-65.51019, 41.10127), (-64.00231, 41.10127), (-64.00231, 41.90423), (-65.51019, 41.90423)]),
]

# Groups of another year: (label, sectors, quarters, zones).
OTHER_RULES = [("881_Z1_Q1", [881], [1, 2], [1, 2]), ("885_Z12345_Q1234", [885, 311], None, None)]

SIGNIFICANT_GROUPS = ["311_Z12345_Q1234", "881_Z1_Q1", "881_Z2_Q2", "881_Z45_Q1234", "885_Z12345_Q1234"]


def case_list(expression: str, values: list) -> str:
    """``CASE`` giving the n-th value for n = 0, 1, ..."""
    arms = " ".join(f"when {i} then {v}" for i, v in enumerate(values) if v is not None)
    return f"case {expression} {arms} else null end"


def _packed(degrees: str, minutes: str, hundredths: str) -> str:
    two = lambda e: f"lpad(cast({e} as string), 2, '0')"
    return f"concat({two(degrees)}, {two(minutes)}, {two(hundredths)})"


# Sets: up to three per order. The set number drives the position.
_K = "(o_orderkey * 7 + (l_linenumber % 3) * 13)"

STANDIN_SQL = {
    # landings database
    "pro_spc_info": f"""
        select o_custkey as vr_number_fishing, o_orderkey as trip_id, o_orderdate as landed_date,
               l_orderkey * 10 + l_linenumber % 3 as log_efrt_std_info_id,
               date '2024-01-01' + cast(o_orderkey % 30 as int) as date_fished,
               cast(substr(o_orderpriority, 1, 1) as int) * 10 + 1 as gear_code,
               case when {_K} % 19 = 0 then null
                    else {_packed(f"40 + {_K} % 3", f"{_K} % 60", f"{_K} % 100")} end as latitude,
               case when {_K} % 17 = 0 then null
                    else {_packed(f"64 + {_K} % 5", f"({_K} * 7) % 60", f"({_K} * 3) % 100")} end as longitude,
               500000 + o_custkey * 2 + o_orderkey % 2 as licence_id, o_orderkey as mon_doc_id,
               case l_returnflag when 'A' then 100 when 'N' then 110 else 170 end as species_code,
               case l_returnflag when 'A' then l_quantity when 'N' then l_quantity * 2e0 else l_quantity / 2e0 end
                   as rnd_weight_kgs,
               198 + (o_orderkey + case when o_orderkey % 10 = 7 and l_linenumber > 3 then 1 else 0 end) % 10 as nafo_unit_area_id, o_custkey as lic_quota_id
        from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey""",
    "vessels": """
        select c_custkey as vr_number, c_name as vessel_name, c_acctbal / 4e0 as gross_tonnage, c_acctbal / 70e0 as loa
        from {customer}""",
    # areas 205 and 206 share a name
    "areas": """
        select 190 + n_nationkey as area_id,
               min(n_name) over (partition by case when n_nationkey = 16 then 15 else n_nationkey end) as area
        from {nation}""",
    "sflt_descs": f"""
        select sflt_desc_id, min(n_name) as desc_eng
        from (select {case_list("n_nationkey", NATION_FLEETS)} as sflt_desc_id, n_name from {{nation}}) t
        where sflt_desc_id is not null group by sflt_desc_id""",
    "sflt_quotas": f"""
        select n_nationkey as sflt_quota_id, {case_list("n_nationkey", NATION_FLEETS)} as sflt_desc_id,
               n_regionkey as fleet_quota_id
        from {{nation}}""",
    "fleet_quotas": "select r_regionkey as fleet_quota_id from {region}",
    "lic_quotas": "select c_custkey as lic_quota_id, c_nationkey as sflt_quota_id from {customer}",
    "mon_doc_entrd_dets": """
        select o_orderkey as mon_doc_id,
               case when o_orderstatus = 'P' and c_nationkey not in (19, 20) then 740 else 741 end as column_defn_id,
               case when c_nationkey in (19, 20) then concat('J', cast(o_orderkey as string))
                    when o_orderstatus = 'F' and o_orderkey % 7 = 0 then null
                    when o_orderstatus = 'F' and o_orderkey % 7 = 1 then 'J0'
                    when o_orderstatus = 'F' then concat('J', cast(o_orderkey as string))
                    when o_orderstatus = 'O' then '' else 'other field' end as data_value
        from {orders} join {customer} on o_custkey = c_custkey""",
    # observer database
    "isvessels": "select c_custkey as vess_id, cast(c_custkey as string) as cfv, c_name as vessel_name from {customer}",
    "istrips": """
        select o_orderkey as trip_id, o_custkey as vess_id, concat('J', cast(o_orderkey as string)) as trip,
               7001 + o_orderkey % 2 as tripcd_id, 100000 + o_orderkey as conf_number,
               cast(o_orderdate as date) + cast(o_orderkey % 9 - 4 as int) as landing_date
        from {orders} where o_orderstatus = 'F'""",
    "isfishsets": """
        select l_orderkey * 10 + l_linenumber as fishset_id, l_orderkey as trip_id, min(l_suppkey) as gear_id,
               case min(l_partkey) % 5 when 0 then '5ZEJ' when 1 then '5ZEM' when 2 then '5ZU' when 3 then '4XP'
                    else '5YB' end as nafarea_id,
               case when l_linenumber = 7 and min(l_suppkey) % 4 = 0 then 7 else 1 end as setcd_id,
               l_linenumber as set_no,
               case when max(l_quantity) >= 49e0 then 12 when max(l_quantity) >= 47e0 then null
                    when min(l_linestatus) = 'F' then 11 else 10 end as specscd_id
        from {lineitem} group by l_orderkey, l_linenumber""",
    "issetprofile": """
        select l_orderkey * 10 + l_linenumber as fishset_id, l_shipdate as setdate,
               40e0 + l_quantity / 20e0 as latitude, 64e0 + l_discount * 50e0 as longitude,
               case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end as pntcd_id
        from {lineitem}""",
    "isgears": f"""
        select s_suppkey as gear_id, {case_list("s_nationkey % 6", [12, 12, 51, 41, 71, 62])} as gearcd_id
        from {{supplier}}""",
    "isgearfeatures": """
        select s_suppkey as gear_id, 88 + s_suppkey % 3 as gearfcd_id from {supplier}
        union all select s_suppkey as gear_id, 91 as gearfcd_id from {supplier}""",
    # positions, trips by fleet, zone vertices
    "positions": """
        select user_id as vr_number, ts as position_utc_date, 40e0 + (value % 30e0) / 10e0 as latitude,
               -(64e0 + (hour(ts) + minute(ts) / 60e0) * 5e0 / 24e0) as longitude
        from {events}""",
    "chp_trips": """
        select o_custkey as vr_number, o_orderkey as trip_id, cast(o_orderdate as date) as landed_date,
               case when substr(o_orderpriority, 1, 1) in ('1', '2') then 'MOBILE' else 'FIXED' end as fleet,
               case when o_orderstatus = 'P' then '4X' else '5Z' end as stock
        from {orders}""",
    "vertices": "select * from (values {rows}) as t(zone_id, ring_id, seq, x, y)".replace("{rows}", ", ".join(
        f"({zone}, {ring}, {seq}, {x}e0, {y}e0)" for zone, ring, points in ZONE_RINGS for seq, (x, y) in enumerate(points)
    )),
}

#: Test tables that are laid out by a key ahead of a stand-in: its own sum and what is looked up by trip follow one move.
LAID_OUT = {"isfishsets": {"lineitem": "l_orderkey"}}

TEST_TABLES = ["region", "nation", "customer", "supplier", "orders", "lineitem", "events"]


class Standins:
    """The stand-in tables of one test-data folder, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cache  # noqa: B019
    def _base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cache  # noqa: B019
    def table(self, name: str) -> DataFrame:
        sql = STANDIN_SQL[name]
        used = {t: self._base(t) for t in TEST_TABLES if "{" + t + "}" in sql}
        used |= {t: used[t].repartition(key) for t, key in LAID_OUT.get(name, {}).items()}
        return self.spark.sql(sql, **used)

    def landing_tables(self) -> LandingTables:
        return LandingTables(**{n: self.table(n) for n in LandingTables.__dataclass_fields__})

    def observer_tables(self) -> ObserverTables:
        return ObserverTables(**{n: self.table(n) for n in ObserverTables.__dataclass_fields__})

    def zones(self) -> DataFrame:
        return zones_from_vertices(self.table("vertices"))

    def flags(self) -> DataFrame:
        rows = ", ".join(f"('{g}', 1)" for g in SIGNIFICANT_GROUPS)
        return self.spark.sql(f"select * from (values {rows}) as t(analysis_group, significant)")
