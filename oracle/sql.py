"""Independent SQL for the registered queries, for comparison in DuckDB."""

from __future__ import annotations

# --- building blocks -----------------------------------------------------------

VISITS = """
k as (
 select *, (l_orderkey*7 + l_linenumber*5) % 24 * 3600 + (l_partkey % 60) * 60 as in_s,
  (6 + (l_orderkey*13 + l_partkey*7 + l_suppkey*3) % 120)
   * (case when (l_orderkey + l_partkey) % 20 = 0 then 6 else 1 end) * 3600 as stay_s,
  l_partkey % 10 as t, l_linenumber % 5 as z
 from lineitem join orders on l_orderkey = o_orderkey),
visits as (
 select
  concat(l_orderkey,'-',l_linenumber,'-',l_partkey,'-',l_suppkey,'-',
         cast(cast(l_shipdate as date) as varchar),'-',cast(round(l_extendedprice*100) as bigint)) as visit_id,
  l_orderkey as o, l_partkey as p,
  concat('MSCU', lpad(cast(l_orderkey as varchar), 7, '0')) as container_id,
  cast(case when z in (0,1) then 20 when l_partkey % 41 = 0 then 45 else 40 end as int) as size_ft,
  case when t < 6 then 'dry' when t < 8 then 'reefer' when t = 8 then 'hazardous' else 'empty' end as container_type,
  1.0e0 + l_quantity * 0.6e0 as weight_tons,
  l_shipdate + to_seconds(in_s) as gate_in_time,
  case when l_partkey % 33 = 0 then null else l_shipdate + to_seconds(in_s + stay_s) end as gate_out_time,
  case l_returnflag when 'N' then 'import' when 'A' then 'export' else 'transhipment' end as movement_type,
  case when t < 6 then case l_suppkey % 3 when 0 then 'A01' when 1 then 'A02' else 'B01' end
       when t < 8 then case l_suppkey % 2 when 0 then 'R01' else 'R02' end
       when t = 8 then 'H01' else 'E01' end as yard_block,
  case when l_partkey % 17 = 0 then null else concat(
    case when z in (0,1) then '2' when l_partkey % 41 = 0 then 'L' else '4' end,
    case when l_suppkey % 4 = 0 then '5' else '2' end,
    case when t < 6 or t = 9 then 'G' when t < 8 then 'R' else 'T' end, '1') end as iso_type_code,
  cast(1 + l_partkey % 40 as int) as yard_bay, cast(1 + l_suppkey % 8 as int) as yard_row,
  cast(1 + l_linenumber % 5 as int) as yard_tier,
  concat('VESSEL_', l_suppkey % 16) as vessel_name, concat('LINE_', l_suppkey % 9) as shipping_line,
  case l_returnflag when 'A' then case o_orderpriority when '2-HIGH' then 'rail'
       when '3-MEDIUM' then 'barge' else 'truck' end else 'vessel' end as gate_in_mode,
  case l_returnflag when 'N' then case o_orderpriority when '2-HIGH' then 'rail'
       when '3-MEDIUM' then 'barge' else 'truck' end else 'vessel' end as gate_out_mode
 from k)"""


def feats(threshold: float = 7) -> str:
    return VISITS + f""",
dwelt as (
 select *, date_diff('second', gate_in_time, gate_out_time) as dwell_s,
  date_diff('second', gate_in_time, gate_out_time) / 3600e0 as dwell_hours,
  date_diff('second', gate_in_time, gate_out_time) / 3600e0 / 24e0 as dwell_days,
  cast(case when size_ft = 20 then 1 else 2 end as int) as teu_equivalent,
  case movement_type when 'export' then 5 when 'transhipment' then 7 else 3 end as free_days
 from visits),
priced as (
 select *, greatest(0e0, dwell_days - free_days) as billable from dwelt),
charged as (
 select *,
  least(4e0, billable) * 15e0 * teu_equivalent
  + least(6e0, greatest(0e0, billable - 4e0)) * 30e0 * teu_equivalent
  + least(11e0, greatest(0e0, billable - 10e0)) * 55e0 * teu_equivalent
  + least(9978e0, greatest(0e0, billable - 21e0)) * 85e0 * teu_equivalent
  + case container_type when 'reefer' then 25e0 when 'hazardous' then 18e0 else 0e0 end
    * dwell_days * teu_equivalent as charge
 from priced),
milled as (
 select *, case when dwell_days is not null then cast(round_even(charge * 1e6, 0) as bigint) end as micro from charged),
feats as (
 select *,
  case when dwell_hours < 24 then 'short' when dwell_days > 1 and dwell_days <= 3 then 'normal'
   when dwell_days > 3 and dwell_days <= {threshold} then 'long'
   when dwell_days > {threshold} then 'overstay' else 'unknown' end as dwell_category,
  cast(case when dwell_days > {threshold} then 1 else 0 end as int) as is_overstay,
  micro // 10000 + case when micro % 10000 > 5000
    or (micro % 10000 = 5000 and (micro // 10000) % 2 = 1) then 1 else 0 end as cents,
  (micro // 10000 + case when micro % 10000 > 5000
    or (micro % 10000 = 5000 and (micro // 10000) % 2 = 1) then 1 else 0 end) / 100e0 as storage_cost_usd,
  case when gate_in_mode is not null and gate_out_mode is not null
   then gate_in_mode || '→' || gate_out_mode else 'unknown' end as flow_path,
  cast(coalesce(substring(iso_type_code, 2, 1) = '5', false) as int) as is_high_cube,
  coalesce(case substring(iso_type_code, 3, 1) when 'G' then 'dry' when 'B' then 'dry' when 'R' then 'reefer'
   when 'T' then 'tank' when 'U' then 'special' when 'P' then 'special' end, container_type) as iso_container_group
 from milled)"""


FEATS = feats()
MEAN_DAYS = "cast(sum(dwell_s) as double) / 86400e0 / count(dwell_s)"
MONEY = "cast(sum(cents) as double) / 100e0"

BLOCKS = """
blocks(yard_block, teu_capacity, reefer_plug_count, yard_rows, yard_bays, max_tier) as (values
 ('A01', 1600, null, 8, 40, 5), ('A02', 1600, null, 8, 40, 5), ('B01', 1400, null, 8, 35, 5),
 ('R01', 720, 180, 6, 25, 4), ('R02', 480, 100, 5, 20, 4), ('H01', 270, null, 4, 15, 3),
 ('E01', 2160, null, 8, 45, 6))"""

GRID = """
bounds as (select min(cast(gate_in_time as date)) as lo, max(cast(gate_in_time as date)) as hi from visits),
days as (select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as date from bounds),
stays as (
 select yard_block, container_type, teu_equivalent, is_overstay, yard_tier,
  cast(unnest(generate_series(cast(gate_in_time as date),
   least(coalesce(cast(gate_out_time as date), hi), hi), interval 1 day)) as date) as date
 from feats, bounds),
grid as (select yard_block, date from (select distinct yard_block from visits), days),
occ as (
 select g.yard_block, g.date, count(s.teu_equivalent) as container_count,
  coalesce(sum(s.teu_equivalent), 0) as teu_occupied,
  coalesce(sum(s.teu_equivalent * s.is_overstay), 0) as overstay_teu,
  count(s.teu_equivalent) filter (where s.container_type = 'reefer') as reefer_count,
  avg(s.yard_tier) as avg_stack_height
 from grid g left join stays s on g.yard_block = s.yard_block and g.date = s.date
 group by all)"""

BLOCK_DAY = GRID + "," + BLOCKS + """,
block_day as (
 select date, o.yard_block, container_count, cast(teu_occupied as bigint) as teu_occupied, teu_capacity,
  teu_occupied / cast(teu_capacity as double) * 100 as block_utilization_pct,
  reefer_count / cast(reefer_plug_count as double) * 100 as reefer_plug_util_pct,
  avg_stack_height,
  case when teu_occupied > 0 then overstay_teu / cast(teu_occupied as double) else 0 end as overstay_teu_ratio
 from occ o left join blocks b on o.yard_block = b.yard_block)"""

PROXY = GRID + """,
proxy as (
 select date, yard_block, cast(max(teu_occupied) over (partition by yard_block) as int) as teu_capacity,
  teu_occupied / cast(max(teu_occupied) over (partition by yard_block) as double) * 100 as block_utilization_pct
 from occ)"""

EVENTS = """
gate_events as (
 select gate_in_time as ts, 'in' as direction from visits where gate_in_time is not null
 union all select gate_out_time, 'out' from visits where gate_out_time is not null),
hourly as (
 select cast(ts as date) as date, cast(hour(ts) as int) as hour, count(*) as gate_throughput_hr
 from gate_events group by all)"""

AS_OF = "timestamp '2001-06-01'"

FAULTY = VISITS + """,
broken as (
 select container_id, size_ft, yard_block, iso_type_code, yard_bay, yard_row, yard_tier, vessel_name,
  shipping_line, gate_in_mode, gate_out_mode, o, p, visit_id as base_id,
  case when p % 20 >= 7 then container_type end as container_type,
  case when o % 40 = 0 then -weight_tons else weight_tons end as base_weight,
  case when p % 66 = 1 then 'INVALID_TYPE' else movement_type end as movement_type,
  case when p % 7 = 0 then gate_out_time else gate_in_time end as gate_in_time,
  case when p % 7 = 0 then gate_in_time else gate_out_time end as gate_out_time
 from visits),
copies as (
 select *, 0 as copy from broken
 union all select *, 1 from broken where o % 100 = 0
 union all select *, 2 from broken where o % 100 = 1),
faulty as (
 select * exclude (base_id, base_weight, copy), base_id || '/' || copy as visit_id,
  case when copy = 2 then base_weight + 1 else base_weight end as weight_tons,
  coalesce(gate_out_time < gate_in_time, false) as is_reversed,
  coalesce(gate_in_time > """ + AS_OF + """, false) as is_future_in,
  coalesce(gate_out_time > """ + AS_OF + """, false) as is_future_out
 from copies),
firsts as (
 select *, row_number() over (partition by container_id, gate_in_time order by visit_id) as rn from faulty),
clean as (select * from firsts where rn = 1 and not is_reversed and not is_future_in and not is_future_out)"""

DATA_COLUMNS = [
    "container_id", "size_ft", "container_type", "weight_tons", "gate_in_time",
    "gate_out_time", "movement_type", "yard_block", "iso_type_code", "yard_bay",
    "yard_row", "yard_tier", "vessel_name", "shipping_line", "gate_in_mode", "gate_out_mode",
]


def _check_rows(rows: list[tuple[str, str, str, str, str]], counters: str, source: str) -> str:
    body = "\n union all ".join(
        f"select '{check}' as \"check\", {level} as level, '{column}' as \"column\", "
        f"'{metric}' as metric, cast({value} as double) as value from n"
        for check, column, metric, value, level in rows)
    return f"n as (select {counters} from {source}),\nresult as ({body})"


def _row_check_parts() -> str:
    counters, rows = ["count(*) as total"], [("total_rows", "*", "rows", "total", "'ok'")]

    def flag(check, column, condition, level="warning"):
        name = f"{check}_{column}"
        counters.append(f"count(*) filter (where {condition}) as {name}")
        rows.append((check, column, "rows", name, f"case when {name} > 0 then '{level}' else 'ok' end"))

    flag("domain", "size_ft", "size_ft not in (20, 40, 45)")
    flag("domain", "container_type",
         "container_type not in ('dry','reefer','hazardous','empty','special','tank')")
    flag("domain", "movement_type", "movement_type not in ('import','export','transhipment')")
    for mode in ("gate_in_mode", "gate_out_mode"):
        flag("domain", mode, f"{mode} not in ('vessel','truck','rail','barge')")
    flag("non_positive", "weight_tons", "weight_tons <= 0")
    for c in DATA_COLUMNS:
        counters.append(f"count(*) filter (where {c} is null) as nulls_{c}")
        pct = f"round(nulls_{c} / cast(total as double) * 100, 2)"
        if c == "gate_out_time":
            level = f"case when {pct} > 30 then 'warning' else 'ok' end"
        elif c in DATA_COLUMNS[:8]:
            level = f"case when {pct} > 20 then 'error' when {pct} > 10 then 'warning' else 'ok' end"
        else:
            level = "'ok'"
        rows.append(("nulls", c, "rows", f"nulls_{c}", "'ok'"))
        rows.append(("nulls", c, "pct", pct, level))
    flag("unreadable", "gate_in_time", "gate_in_time is null", "error")
    counters.append("count(*) filter (where is_reversed) as reversed_rows")
    share = "reversed_rows / cast(total as double) * 100"
    rows.append(("reversed", "gate_out_time", "rows", "reversed_rows",
                 f"case when {share} > 5 then 'error' when reversed_rows > 0 then 'warning' else 'ok' end"))
    rows.append(("reversed", "gate_out_time", "pct", f"round({share}, 6)", "'ok'"))
    flag("future", "gate_in_time", "is_future_in")
    flag("future", "gate_out_time", "is_future_out")
    flag("overweight", "weight_tons", "weight_tons > 40")
    flag("underweight", "weight_tons", "weight_tons < 1")
    return _check_rows(rows, ", ".join(counters), "faulty")


DUPLICATES = f"""
variants as (select {', '.join(DATA_COLUMNS)}, count(*) as n from faulty group by all),
keyed as (select container_id, gate_in_time, sum(n) as n, count(*) as v from variants group by all),
dups as (select sum(n - v) as exact_duplicates, sum(n - 1) as key_duplicates from keyed),
dup_rows as (
 select 'exact_duplicates' as "check", case when exact_duplicates > 0 then 'warning' else 'ok' end as level,
  '*' as "column", 'rows' as metric, cast(exact_duplicates as double) as value from dups
 union all select 'key_duplicates', case when key_duplicates > 0 then 'warning' else 'ok' end,
  'container_id,gate_in_time', 'rows', cast(key_duplicates as double) from dups)"""

COVERAGE = """select count(*) as valid_rows, count(distinct container_id) as unique_containers,
 count(distinct yard_block) as unique_blocks, cast(min(gate_in_time) as date) as start_date,
 cast(max(gate_in_time) as date) as end_date,
 cast(floor(date_diff('second', min(gate_in_time), max(gate_in_time)) / 86400e0) as bigint) as span_days"""


def minimum_rows(source: str) -> str:
    return f"""
cover as ({COVERAGE} from {source}),
min_rows as (
 select 'valid_rows' as "check", 'ok' as level, '*' as "column", 'valid_rows' as metric,
  cast(valid_rows as double) as value from cover
 union all select 'minimum', case when unique_containers < 100 then 'error' else 'ok' end,
  'container_id', 'unique_containers', cast(unique_containers as double) from cover
 union all select 'minimum', case when span_days < 30 then 'error' else 'ok' end,
  'gate_in_time', 'span_days', cast(span_days as double) from cover
 union all select 'minimum', case when unique_blocks < 2 then 'warning' else 'ok' end,
  'yard_block', 'unique_blocks', cast(unique_blocks as double) from cover)"""


ALL_CHECKS = (FAULTY + ",\n" + _row_check_parts() + "," + DUPLICATES + "," + minimum_rows("clean")
              + ",\nall_checks as (select * from result union all select * from dup_rows "
                "union all select * from min_rows)")

SCALED = FEATS + """,
inputs as (
 select *, coalesce(storage_cost_usd, 0) as x_cost from feats where dwell_hours is not null),
scaling as (
 select avg(dwell_hours) as dwell_hours__mean, stddev_pop(dwell_hours) as dwell_hours__std,
  skewness(dwell_hours) as dwell_hours__skew, avg(ln(1 + dwell_hours)) as dwell_hours__log_mean,
  stddev_pop(ln(1 + dwell_hours)) as dwell_hours__log_std,
  avg(teu_equivalent) as teu_equivalent__mean, stddev_pop(teu_equivalent) as teu_equivalent__std,
  avg(x_cost) as storage_cost_usd__mean, stddev_pop(x_cost) as storage_cost_usd__std,
  skewness(x_cost) as storage_cost_usd__skew, avg(ln(1 + x_cost)) as storage_cost_usd__log_mean,
  stddev_pop(ln(1 + x_cost)) as storage_cost_usd__log_std,
  avg(weight_tons) as weight_tons__mean, stddev_pop(weight_tons) as weight_tons__std
 from inputs),
scaled as (
 select inputs.*,
  case when abs(dwell_hours__skew) > 2 then (ln(1 + dwell_hours) - dwell_hours__log_mean) / dwell_hours__log_std
   else (dwell_hours - dwell_hours__mean) / dwell_hours__std end as z1,
  (teu_equivalent - teu_equivalent__mean) / teu_equivalent__std as z2,
  case when abs(storage_cost_usd__skew) > 2 then (ln(1 + x_cost) - storage_cost_usd__log_mean) / storage_cost_usd__log_std
   else (x_cost - storage_cost_usd__mean) / storage_cost_usd__std end as z3,
  (weight_tons - weight_tons__mean) / weight_tons__std as z4
 from inputs, scaling)"""

LABELLED = SCALED + """,
centres(i, c1, c2, c3, c4) as (values
 (0, -0.9e0, 0.0e0, -0.8e0, 0.0e0), (1, 0.2e0, -1.1e0, 0.6e0, 0.0e0), (2, 0.2e0, 0.9e0, 0.7e0, -0.8e0),
 (3, 0.3e0, 0.9e0, -0.4e0, 0.9e0), (4, 2.2e0, 0.3e0, 1.9e0, 0.1e0)),
ranked as (
 select scaled.*, i, (z1-c1)**2 + (z2-c2)**2 + (z3-c3)**2 + (z4-c4)**2 as d,
  row_number() over (partition by visit_id order by (z1-c1)**2 + (z2-c2)**2 + (z3-c3)**2 + (z4-c4)**2, i) as rn
 from scaled, centres),
labelled as (select *, cast(i as int) as cluster, d as squared_distance from ranked where rn = 1),
stats as (
 select cluster, count(*) as n, sum(z1*z1 + z2*z2 + z3*z3 + z4*z4) as ss,
  sum(z1) as s1, sum(z2) as s2, sum(z3) as s3, sum(z4) as s4 from labelled group by cluster)"""

def fixed_models() -> str:
    """Labels and distances of the given centres for every model of the selection queries."""
    models = [("KMeans", 3, "0,1,2"), ("KMeans", 4, "0,1,2,3"), ("KMeans", 5, "0,1,2,3,4"),
              ("Hierarchical", 4, "1,2,3,4"), ("Hierarchical", 3, "2,3,4")]
    chosen = " union all ".join(
        f"select '{a}' as algorithm, {k} as k, unnest([{ids}]) as i, unnest(range({k})) as cluster" for a, k, ids in models)
    return LABELLED + f""",
chosen as ({chosen}),
gaps as (
 select visit_id, z1, z2, z3, z4, dwell_hours, x_cost, algorithm, k, cluster,
  sqrt((z1-c1)**2 + (z2-c2)**2 + (z3-c3)**2 + (z4-c4)**2) as gap from scaled, chosen join centres using (i)),
placed as (
 select *, row_number() over (partition by visit_id, algorithm, k order by gap, cluster) as rn,
  lead(gap) over (partition by visit_id, algorithm, k order by gap, cluster) as other from gaps),
own as (select * from placed where rn = 1),
sums as (
 select algorithm, k, cluster, count(*) as n, sum(z1*z1 + z2*z2 + z3*z3 + z4*z4) as ss, sum(z1) as s1, sum(z2) as s2,
  sum(z3) as s3, sum(z4) as s4, sum(dwell_hours) / count(*) as mean_dwell, sum(x_cost) as cost,
  sum(case when other > 0 then (other - gap) / greatest(other, gap) else 0 end) as score from own group by all),
totals as (
 select algorithm, k, count(*) as c, sum(n) as rows, sum(ss) as ss, sum((s1*s1 + s2*s2 + s3*s3 + s4*s4) / n) as between_ss,
  (sum(s1)**2 + sum(s2)**2 + sum(s3)**2 + sum(s4)**2) / sum(n) as grand, min(n) as least_n, max(n) as most_n,
  sum(score) / sum(n) as silhouette, max(cost) / sum(cost) as max_revenue_share from sums group by all),
scatter as (
 select algorithm, k, cluster, s1/n as m1, s2/n as m2, s3/n as m3, s4/n as m4,
  avg(sqrt((z1-s1/n)**2 + (z2-s2/n)**2 + (z3-s3/n)**2 + (z4-s4/n)**2)) as s
 from own join sums using (algorithm, k, cluster) group by all),
worst as (
 select a.algorithm, a.k, a.cluster,
  max((a.s + b.s) / sqrt((a.m1-b.m1)**2 + (a.m2-b.m2)**2 + (a.m3-b.m3)**2 + (a.m4-b.m4)**2)) as r
 from scatter a join scatter b on a.algorithm = b.algorithm and a.k = b.k and a.cluster <> b.cluster group by all),
db as (select algorithm, k, avg(r) as davies_bouldin from worst group by all),
steps as (
 select algorithm, k, (mean_dwell - lag(mean_dwell) over (partition by algorithm, k order by mean_dwell)) / mean_dwell as gap
 from sums),
contrast as (select algorithm, k, min(gap) as min_dwell_gap from steps group by all),
metrics as (
 select algorithm, k, ss - between_ss as inertia,
  (between_ss - grand) * (rows - c) / ((ss - between_ss) * (c - 1)) as calinski_harabasz,
  least_n / cast(rows as double) * 100 as min_pct, most_n / cast(rows as double) * 100 as max_pct,
  davies_bouldin, silhouette, min_dwell_gap, max_revenue_share
 from totals join db using (algorithm, k) join contrast using (algorithm, k))"""


def best_model(case: str, min_pct: float = 3, max_k: int = 8, margin: float | None = None, strict: bool = False) -> str:
    low, high = (5, 40) if strict else (min_pct, 55)
    sized = f"min_pct >= {low} and max_pct <= {high}" + (
        " and coalesce(min_dwell_gap, 1) > 0.10 and coalesce(max_revenue_share, 0) <= 0.60" if strict else "")
    near = "k * 0" if margin is None else f"case when s >= top - {margin} then 0 else 1 end"
    fewer = "k * 0" if margin is None else f"case when s >= top - {margin} then k else 999 end"
    return f"""
select * from (select '{case}' as "case", algorithm, k, rule, s as silhouette,
 case when s > 0.70 then 'Strong structure' when s > 0.50 then 'Reasonable structure' when s > 0.25 then 'Weak but usable'
  else 'No meaningful structure' end as quality,
 case rule when 2 then 'size checks failed; fewer segments preferred' when 3 then 'forced four segments'
  when 4 then 'no model passed the size checks' end as warning
 from (select *, max(s) over (partition by rule) as top from (
  select *, round(silhouette, 4) as s, case when {sized} then 1 when min_pct >= 2 and max_pct <= 65 and k <= 5 then 2
   when k = 4 then 3 else 4 end as rule from metrics where k <= {max_k}))
 order by rule, {near}, {fewer}, s desc, k, case algorithm when 'KMeans' then 0 else 1 end limit 1)"""


CARGO_GROUPS = FEATS + """,
points as (
 select row_number() over (order by yard_block, container_type, movement_type) as id, container_type, movement_type,
  round(avg(dwell_days), 6) as x, round(sum(teu_equivalent) / cast(count(*) as double), 6) as y,
  round(avg(coalesce(weight_tons, 0)) / 10, 6) as z, cast(count(*) as double) as w
 from feats where dwell_days is not null group by yard_block, container_type, movement_type)"""
# One merge a step: the pair whose union adds least inertia becomes one row.
WARD = CARGO_GROUPS + """,
merges(step, id, w, x, y, z, grown) as (
 select 0, id, w, x, y, z, cast(0 as double) from points
 union all
 (with pairs as (
   select a.step, a.id as a, b.id as b, a.w * b.w / (a.w + b.w) * ((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) as grown
   from merges a join merges b on a.id < b.id),
  best as (select * from pairs order by grown, a, b limit 1)
  select m.step + 1, case when m.id = best.b then best.a else m.id end, sum(m.w), sum(m.w * m.x) / sum(m.w),
   sum(m.w * m.y) / sum(m.w), sum(m.w * m.z) / sum(m.w), any_value(best.grown) from merges m, best group by 1, 2)),
steps as (select step, count(*) as k, max(grown) as grown from merges group by step)"""


PROFILES = LABELLED + f""",
tops as (
 select cluster, col, value, n, row_number() over (partition by cluster, col order by n desc, value) as rn from (
  select cluster, 'm' as col, movement_type as value, count(*) as n from labelled group by all
  union all select cluster, 't', container_type, count(*) from labelled group by all
  union all select cluster, 'f', flow_path, count(*) from labelled group by all)),
base as (
 select cluster, count(*) as "count", {MEAN_DAYS} as mean_dwell_days, median(dwell_days) as median_dwell_days,
  sum(teu_equivalent) / cast(count(*) as double) as mean_teu,
  {MONEY} / count(cents) as mean_storage_cost,
  sum(is_overstay) / cast(count(*) as double) * 100 as overstay_pct,
  sum(teu_equivalent) as teu, {MONEY} as revenue,
  count(*) filter (where container_type = 'empty') / cast(count(*) as double) as empty_share,
  count(*) filter (where container_type = 'reefer') / cast(count(*) as double) as reefer_share
 from labelled group by cluster),
profiles as (
 select b.cluster, "count", mean_dwell_days, median_dwell_days, mean_teu, mean_storage_cost,
  m.value as dominant_movement, m.n / cast("count" as double) * 100 as movement_pct,
  t.value as dominant_container_type, t.n / cast("count" as double) * 100 as container_type_pct,
  f.value as dominant_flow_path, overstay_pct,
  teu / cast(sum(teu) over () as double) * 100 as teu_share_pct,
  revenue * 100 / sum(revenue) over () as revenue_share_pct, empty_share, reefer_share
 from base b
 left join tops m on m.cluster = b.cluster and m.col = 'm' and m.rn = 1
 left join tops t on t.cluster = b.cluster and t.col = 't' and t.rn = 1
 left join tops f on f.cluster = b.cluster and f.col = 'f' and f.rn = 1)"""

NAMED = PROFILES + """,
based as (
 select *, case when round(mean_dwell_days, 2) <= 1 then 'Fast Movers' when round(mean_dwell_days, 2) <= 3 then 'Efficient Operators'
  when round(mean_dwell_days, 2) <= 7 then 'Standard Dwellers' when round(mean_dwell_days, 2) <= 14 then 'Extended Stay'
  when round(mean_dwell_days, 2) <= 30 then 'Overstayers' else 'Chronic Blockers' end as base_label from profiles),
grouped as (
 select *, count(*) over (partition by base_label) as same,
  row_number() over (partition by base_label order by round(mean_dwell_days, 2), cluster) as rk from based),
named as (
 select *, case when same = 1 then base_label else base_label || ' ('
   || case when round(mean_teu, 2) < 1.5 then '20ft' else '40ft' end
   || case when same < 3 or rk = 1 then ')' when rk = same then ', longest dwell)' else ', mid-range)' end end as label
 from grouped)"""


def daily(by_block: bool) -> str:
    series = "yard_block" if by_block else "'terminal'"
    return FEATS + "," + BLOCK_DAY + f""",
daily as (
 select {series} as series_id, date, cast(sum(teu_occupied) as double) as value
 from block_day group by all)"""


def series(by_block: bool, cut: str = "") -> str:
    return daily(by_block) + f""",
folded as (
 select series_id {cut} as series_id, min(date) as start_date, list(value order by date) as y,
  cast(greatest(floor(count(*) * 0.8e0), 1) as int) as n
 from daily group by all),
series as (
 select series_id, start_date, n, y[1:n] as train, y[n+1:] as test, len(y) - n as m from folded)"""


HW_STEPS = """,
state as (
 select series_id, 0 as t, list_sum(train[1:7]) / 7e0 as level,
  (list_sum(train[8:14]) / 7e0 - list_sum(train[1:7]) / 7e0) / 7 as trend,
  [train[1] - list_sum(train[1:7]) / 7e0, train[2] - list_sum(train[1:7]) / 7e0,
   train[3] - list_sum(train[1:7]) / 7e0, train[4] - list_sum(train[1:7]) / 7e0,
   train[5] - list_sum(train[1:7]) / 7e0, train[6] - list_sum(train[1:7]) / 7e0,
   train[7] - list_sum(train[1:7]) / 7e0] as seasonal
 from series where n >= 14
 union all
 select series_id, t, level, trend,
  seasonal[1:slot] || [(value - level) * 0.1e0 + season * 0.9e0] || seasonal[slot+2:7]
 from (
  select c.series_id, c.t + 1 as t, slot, season, value, new_level as level,
   (new_level - c.level) * 0.1e0 + c.trend * 0.9e0 as trend, seasonal
  from (
   select st.*, (st.t + 1) % 7 as slot, st.seasonal[(st.t + 1) % 7 + 1] as season, s.train[st.t + 2] as value,
    (s.train[st.t + 2] - st.seasonal[(st.t + 1) % 7 + 1]) * 0.2e0 + (st.level + st.trend) * 0.8e0 as new_level
   from state st join series s using (series_id) where st.t + 1 < s.n) c)),
final as (select st.* from state st join series s on s.series_id = st.series_id and st.t = s.n - 1),
hw as (
 select s.series_id, 'HoltWinters_Additive' as model, start_date, n, m, t as pos, 'train' as zone,
  train[t+1] as actual, level + trend + seasonal[t % 7 + 1] as predicted
 from state join series s using (series_id)
 union all
 select s.series_id, 'HoltWinters_Additive', start_date, n, m, n + h - 1,
  case when h <= m then 'test' else 'future' end, case when h <= m then test[h] end,
  level + h * trend + seasonal[(n + h - 1) % 7 + 1]
 from (select *, unnest(generate_series(1, m + 14)) as h from series) s join final using (series_id))"""

def smoothing(source: str, name: str, multiplicative: bool = False) -> str:
    """Smoothing states of ``source`` (id, n, train, a, b, g) with the squared error so far."""
    join, split = ("*", "/") if multiplicative else ("+", "-")
    level = "list_sum(train[1:7]) / 7e0"
    trend = f"((list_sum(train[8:14]) / 7e0 - {level}) / 7)"
    start = ", ".join(f"train[{i}] {split} ({level})" for i in range(1, 8))
    return f""",
{name} as (
 select id, 0 as t, {level} as level, {trend} as trend, [{start}] as seasonal,
  (train[1] - (({level} + {trend}) {join} (train[1] {split} ({level})))) ** 2 as sse
 from {source}
 union all
 select id, t, level, trend,
  seasonal[1:slot] || [(value {split} level) * g + season * (1 - g)] || seasonal[slot+2:7], sse
 from (
  select id, t, slot, season, value, g, new_level as level,
   (new_level - old_level) * b + old_trend * (1 - b) as trend, seasonal, sse + error * error as sse
  from (
   select *, value - ((old_level + old_trend) {join} season) as error,
    (value {split} season) * a + (old_level + old_trend) * (1 - a) as new_level
   from (
    select p.id, p.t + 1 as t, (p.t + 1) % 7 as slot, p.seasonal[(p.t + 1) % 7 + 1] as season,
     s.train[p.t + 2] as value, p.level as old_level, p.trend as old_trend, p.seasonal, p.sse, s.a, s.b, s.g
    from {name} p join {source} s on s.id = p.id where p.t + 1 < s.n))))"""


def grid(alphas: str, betas: str, gammas: str) -> str:
    return f""",
points as (
 select a, b, g from (select unnest([{alphas}]) as a), (select unnest([{betas}]) as b), (select unnest([{gammas}]) as g)),
trials as (
 select row_number() over (order by a, b, g) as id, series_id, start_date, n, m, train, test, a, b, g
 from series, points)"""


def best_trial(name: str, states: str) -> str:
    return f""",
{name} as (
 select tr.*, st.level, st.trend, st.seasonal, st.sse from trials tr
 join {states} st on st.id = tr.id and st.t = tr.n - 1
 qualify row_number() over (partition by series_id order by st.sse, a, b, g) = 1)"""


OPTIMISED = series(True) + grid(
    "0.1e0, 0.2e0, 0.4e0, 0.6e0, 0.8e0, 1.0e0", "0e0, 0.05e0, 0.1e0, 0.2e0", "0e0, 0.05e0, 0.1e0, 0.2e0",
) + smoothing("trials", "tried") + best_trial("best", "tried") + """,
optimised as (
 select b.series_id, 'HoltWinters_Optimised_Additive' as model, start_date, b.n, m, t.t as pos, 'train' as zone,
  train[t.t+1] as actual, t.level + t.trend + t.seasonal[t.t % 7 + 1] as predicted
 from best b join tried t on t.id = b.id
 union all
 select series_id, 'HoltWinters_Optimised_Additive', start_date, n, m, n + h - 1,
  case when h <= m then 'test' else 'future' end, case when h <= m then test[h] end,
  level + h * trend + seasonal[(n + h - 1) % 7 + 1]
 from (select *, unnest(generate_series(1, m + 14)) as h from best))"""

def refined(rounds: int) -> str:
    """Compass search from the best trial: six tries a round, halving the step where none is lower."""
    parts = [""",
at_0 as materialized (select series_id, n, train, a, b, g, sse, sse as grid_sse, 0 as h from best)"""]
    for r in range(1, rounds + 1):
        step = "0.1e0 * pow(0.5e0, h)"
        parts.append(f""",
tries_{r} as materialized (
 select row_number() over () as id, series_id, n, train, least(greatest(a + da * {step}, 0e0), 1e0) as a,
  least(greatest(b + db * {step}, 0e0), 1e0) as b, least(greatest(g + dg * {step}, 0e0), 1e0) as g
 from at_{r - 1}, (values (1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)) d(da, db, dg))"""
                     + smoothing(f"tries_{r}", f"folds_{r}") + f""",
found_{r} as materialized (
 select p.series_id, p.a, p.b, p.g, f.sse from tries_{r} p join folds_{r} f on f.id = p.id and f.t = p.n - 1
 qualify row_number() over (partition by p.series_id order by f.sse, p.a, p.b, p.g) = 1),
at_{r} as materialized (
 select l.series_id, l.n, l.train, case when f.sse < l.sse then f.a else l.a end as a,
  case when f.sse < l.sse then f.b else l.b end as b, case when f.sse < l.sse then f.g else l.g end as g,
  least(f.sse, l.sse) as sse, l.grid_sse, l.h + case when f.sse < l.sse then 0 else 1 end as h
 from at_{r - 1} l join found_{r} f using (series_id))""")
    return "".join(parts)


GRID_VALUES = ("0.1e0, 0.2e0, 0.4e0, 0.6e0, 0.8e0, 1.0e0", "0e0, 0.05e0, 0.1e0, 0.2e0", "0e0, 0.05e0, 0.1e0, 0.2e0")

BY_AIC = series(True) + grid(*GRID_VALUES) + smoothing(
    "trials", "added") + smoothing("trials", "multiplied", multiplicative=True) + best_trial(
    "best_added", "added") + best_trial("best_multiplied", "multiplied") + """,
both_forms as (
 select series_id, 'HoltWinters_Optimised_Additive' as model, n * ln(sse / n) + 24 as aic from best_added
 union all select series_id, 'HoltWinters_Optimised_Multiplicative', n * ln(sse / n) + 24
 from best_multiplied where list_min(train) > 0)"""

BACKTEST = daily(True) + """,
folded as (select series_id, list(value order by date) as y from daily group by series_id),
origins as (
 select series_id, y, unnest(generate_series(28, len(y) - 14, 7)) as origin from folded),
trials as (
 select row_number() over () as id, series_id, cast(origin as int) as origin, cast(origin as int) as n, y[1:origin] as train,
  y[origin+1:origin+14] as test, 0.2e0 as a, 0.1e0 as b, 0.1e0 as g from origins)""" + smoothing(
    "trials", "tried") + """,
ahead as (
 select tr.series_id, origin, test[h] as actual, level + h * trend + seasonal[(n + h - 1) % 7 + 1] as predicted
 from (select *, unnest(generate_series(1, 14)) as h from trials) tr
 join tried st on st.id = tr.id and st.t = tr.n - 1)"""

SMA_PARTS = """,
points as (select series_id, n, unnest(generate_series(0, n - 1)) as t, unnest(train) as y from series),
weekday as (select series_id, t % 7 as j, sum(y) / count(*) as mean from points group by all),
centre as (select series_id, sum(mean) / 7e0 as c from weekday group by series_id),
rolled as (
 select a.series_id, a.t, sum(b.y) / count(*) as trend
 from points a join points b on a.series_id = b.series_id and b.t <= a.t and b.t > a.t - least(14, a.n // 2)
 group by all),
slopes as (
 select s.series_id, last.trend as last_trend, (last.trend - before.trend) / 14 as slope
 from series s join rolled last on last.series_id = s.series_id and last.t = s.n - 1
 join rolled before on before.series_id = s.series_id and before.t = greatest(s.n - 14, 0)),
sma as (
 select s.series_id, 'SeasonalMovingAverage' as model, start_date, s.n, m, r.t as pos, 'train' as zone,
  train[r.t+1] as actual, trend + (w.mean - c) as predicted
 from series s join rolled r using (series_id) join weekday w on w.series_id = s.series_id and w.j = r.t % 7
 join centre on centre.series_id = s.series_id
 union all
 select s.series_id, 'SeasonalMovingAverage', start_date, s.n, m, s.n + h,
  case when h < m then 'test' else 'future' end, case when h < m then test[h+1] end,
  greatest(0e0, last_trend + h * slope + (w.mean - c))
 from (select *, unnest(generate_series(0, m + 13)) as h from series) s
 join slopes using (series_id) join weekday w on w.series_id = s.series_id and w.j = (s.n + h) % 7
 join centre on centre.series_id = s.series_id)"""

SES_STEPS = """,
state as (
 select series_id, 0 as t, train[1] as level from series
 union all
 select st.series_id, st.t + 1, s.train[st.t + 2] * 0.3e0 + st.level * 0.7e0
 from state st join series s using (series_id) where st.t + 1 < s.n),
final as (select st.* from state st join series s on s.series_id = st.series_id and st.t = s.n - 1),
ses as (
 select s.series_id, 'SimpleExponentialSmoothing' as model, start_date, n, m, t as pos, 'train' as zone,
  train[t+1] as actual, level as predicted from state join series s using (series_id)
 union all
 select s.series_id, 'SimpleExponentialSmoothing', start_date, n, m, n + h - 1,
  case when h <= m then 'test' else 'future' end, case when h <= m then test[h] end, level
 from (select *, unnest(generate_series(1, m + 14)) as h from series) s join final using (series_id))"""


def curve(model: str) -> str:
    return f"""
select series_id, model, start_date + cast(pos as int) as date, zone, round(actual, 5) as actual,
 round(predicted, 5) as predicted,
 round(case when zone = 'future' then predicted * 0.85e0 end, 5) as band_15pct_low,
 round(case when zone = 'future' then predicted * 1.15e0 end, 5) as band_15pct_high
from {model}"""


ERRORS = """
errors as (
 select series_id, model, avg(abs((actual - predicted) / actual)) filter (where actual <> 0) * 100 as mape,
  sqrt(avg((actual - predicted) ** 2)) as rmse, avg(abs(actual - predicted)) as mae
 from (select * from hw union all select * from sma) where zone = 'test' group by all)"""


def sql(ctes: str, body: str, recursive: bool = False) -> str:
    return f"with {'recursive ' if recursive else ''}{ctes.strip()}\n{body.strip()}"


def ranking(key: str, more_than: int) -> str:
    return FEATS + f""",
means as (
 select {key}, {MEAN_DAYS} as mean_dwell, count(*) as visits from feats
 where dwell_hours is not null and {key} is not null group by {key} having count(*) > {more_than}),
ends as (select first({key} order by mean_dwell desc, {key} desc) as slowest,
 first({key} order by mean_dwell, {key}) as fastest from means)"""


def ranked_rows(key: str) -> str:
    return f"""
select {key}, mean_dwell, visits, case when slowest <> fastest then
 case {key} when slowest then 'slowest' when fastest then 'fastest' end end as position from means, ends"""


def histogram(bins: int, below: int, by_movement: bool) -> str:
    key = "movement_type" if by_movement else "0"
    return FEATS + f""",
kept as (select {key} as key, dwell_days from feats where dwell_days < {below}),
edges as (select key, min(dwell_days) as lo, max(dwell_days) as hi from kept group by key),
binned as (
 select key, cast(least(floor((dwell_days - lo) / (hi - lo) * {bins}), {bins - 1}) as int) as bin, count(*) as visits
 from kept join edges using (key) group by all),
dense as (select key, lo, hi, cast(unnest(generate_series(0, {bins - 1})) as int) as bin from edges)"""


def histogram_rows(bins: int, by_movement: bool) -> str:
    key = "key as movement_type, " if by_movement else ""
    return f"""
select {key}bin, round(lo + (hi - lo) / {bins} * bin, 6) as bin_start,
 round(lo + (hi - lo) / {bins} * (bin + 1), 6) as bin_end, coalesce(visits, 0) as visits
from dense left join binned using (key, bin)"""


PRIORITY = """select visit_id, container_id, dwell_days, yard_block, movement_type, container_type, size_ft,
 shipping_line, vessel_name, storage_cost_usd"""

# --- fixed values: advice sentences of the segments, as in the bands ---------------
ADVICE = """case base_label
 when 'Fast Movers' then 'Optimize gate scheduling to reduce wait times. Pre-position near berth for transhipment efficiency.'
 when 'Efficient Operators' then 'Maintain current processes. Consider loyalty incentives for shipping lines with consistently low dwell.'
 when 'Standard Dwellers' then 'Monitor for drift toward Extended Stay. Send automated pickup reminders at day 3-4.'
 when 'Extended Stay' then 'Investigate root causes (customs holds, documentation gaps). Engage with freight forwarders for improved clearance timelines.'
 when 'Overstayers' then 'Escalate demurrage notices. Relocate to overflow areas to free prime yard space. Engage shipping lines directly for container clearance.'
 else 'Initiate formal clearance procedures. Assess legal options for abandoned cargo. Relocate to peripheral blocks immediately to free operational capacity.' end"""

FORTY_NOTE = " Note: these are predominantly 40ft (2-TEU) containers — each one blocks double the yard capacity of a 20ft unit."

# ------------------------------------------------------------------------------------
CATEGORICAL = ["container_type", "movement_type", "yard_block", "shipping_line",
               "gate_in_mode", "gate_out_mode", "iso_type_code"]
VALUE_COUNTS = "value_counts as (\n " + "\n union all ".join(
    f"select '{c}' as \"column\", {c} as value, count(*) as rows from visits where {c} is not null group by {c}"
    for c in CATEGORICAL) + ")"

NUMERIC = ["size_ft", "weight_tons", "yard_bay", "yard_row", "yard_tier"]

IMPACT = FEATS + f""",
impact as (
 select {MONEY} as total_revenue,
  cast(sum(cents) filter (where is_overstay = 1) as double) / 100e0 as overstay_revenue,
  count(*) filter (where is_overstay = 1) as overstay_count,
  sum(teu_equivalent) filter (where is_overstay = 1) as overstay_teu,
  cast(sum(dwell_s) filter (where is_overstay = 1) as double) / 86400e0
   / count(*) filter (where is_overstay = 1) as mean_overstay_days
 from feats),
impact_row as (
 select *, overstay_revenue / total_revenue * 100 as overstay_revenue_pct,
  overstay_teu * 85e0 as opportunity_cost_daily,
  overstay_revenue / greatest(mean_overstay_days, 1e0) as demurrage_daily from impact)"""


def opportunity(ctes: str, source: str, key: str) -> str:
    return sql(ctes + f""",
o as (
 select {key}, coalesce(cast(sum(teu_equivalent * (dwell_s - free_days * 86400)) filter (where is_overstay = 1) as double)
   / 86400e0, 0) * 85e0 as opportunity_cost, coalesce({MONEY}, 0) as storage_revenue
 from {source} group by {key})""", f"""
select {key}, round(opportunity_cost, 4) as opportunity_cost, storage_revenue,
 round(opportunity_cost - storage_revenue, 4) as net_impact from o""")


# --- one statement per registered query -------------------------------------------

ORACLES: dict[str, str] = {
    "dwell_features": sql(FEATS, """
select visit_id, is_high_cube, iso_container_group, dwell_hours, dwell_days, teu_equivalent, dwell_category,
 is_overstay, storage_cost_usd, flow_path from feats"""),
    "minimal_input_features": sql(FEATS, """
select dwell_category, 'unknown' as flow_path, container_type as iso_container_group, count(*) as visits,
 sum(is_overstay) as overstays, cast(0 as bigint) as with_cost from feats group by all"""),
    "analysis_window": sql(FEATS, f"""
select yard_block, container_type, count(*) as visits, {MEAN_DAYS} as mean_dwell from feats
where gate_in_time >= timestamp '1998-01-01' and gate_in_time < timestamp '1998-07-01'
 and container_type in ('dry', 'reefer') and yard_block in ('A01', 'B01', 'R01') group by all"""),
    "iso_decode": sql(FEATS, """
select iso_type_code, is_high_cube, iso_container_group,
 cast(case substring(iso_type_code, 1, 1) when '2' then 20 when '4' then 40 when 'L' then 45 end as int) as iso_size,
 count(*) as visits from feats group by all"""),
    "teu_by_size": sql(VISITS, """
select size_ft, sum(case size_ft when 20 then 1e0 when 45 then 2.25e0 else 2e0 end) as teu from visits group by all"""),
    "tiered_cost": sql(FEATS, f"""
select movement_type, container_type, count(cents) as charged, {MONEY} as revenue,
 max(storage_cost_usd) as highest from feats group by all"""),
    "tiered_cost_stored_tariff": sql(FEATS, f"""
select movement_type, container_type, count(cents) as charged, {MONEY} as revenue,
 max(storage_cost_usd) as highest from feats group by all"""),
    "open_visit_age": sql(VISITS, f"""
select visit_id, date_diff('second', gate_in_time, {AS_OF}) / 3600e0 / 24e0 as age_days
from visits where gate_out_time is null"""),
    "one_hot_movement": sql(VISITS, """
select visit_id, cast(movement_type = 'import' as int) as movement_type_import,
 cast(movement_type = 'export' as int) as movement_type_export,
 cast(movement_type = 'transhipment' as int) as movement_type_transhipment from visits"""),
    "feature_sanity": sql(FEATS, """
select count(*) filter (where isinf(dwell_hours)) + count(*) filter (where isinf(storage_cost_usd))
  + count(*) filter (where isinf(weight_tons)) as infinite_values,
 count(*) filter (where dwell_hours is null) as missing_dwell_hours,
 count(*) filter (where teu_equivalent is null) as missing_teu_equivalent from feats"""),

    "block_day_utilization": sql(FEATS + "," + BLOCK_DAY, "select * from block_day"),
    "utilization_stored_yard": sql(FEATS + "," + BLOCK_DAY, "select * from block_day"),
    "occupancy_expansion": sql(FEATS + "," + GRID, """
select yard_block, date, container_count, cast(teu_occupied as bigint) as teu_occupied,
 cast(overstay_teu as bigint) as overstay_teu, reefer_count from occ"""),
    "maintained_block_days": sql(FEATS + "," + GRID, """
select yard_block, date, container_count, cast(teu_occupied as bigint) as teu_occupied,
 cast(overstay_teu as bigint) as overstay_teu, reefer_count from occ"""),
    "type_mix_long": sql(FEATS + "," + GRID, """
select date, yard_block, container_type, count(*) as container_count,
 count(*) / cast(sum(count(*)) over (partition by yard_block, date) as double) * 100 as type_pct
from stays group by date, yard_block, container_type"""),
    "calendar_spine": sql(FEATS + "," + GRID, "select date from days"),
    "reefer_plug_trend": sql(FEATS + "," + BLOCK_DAY, """
select date, yard_block, reefer_plug_util_pct from block_day where reefer_plug_util_pct is not null"""),
    "capacity_from_data": sql(FEATS + "," + PROXY, "select * from proxy"),
    "block_summary": sql(FEATS + "," + BLOCK_DAY, """
select yard_block, round(avg(block_utilization_pct), 6) as mean_util, round(max(block_utilization_pct), 6) as max_util,
 round(avg(teu_occupied), 6) as mean_teu from block_day group by yard_block"""),
    "congested_and_underused": sql(FEATS + "," + BLOCK_DAY, """
select * from (
 select yard_block, round(avg(block_utilization_pct), 6) as mean_util, round(max(block_utilization_pct), 6) as max_util,
  round(avg(teu_occupied), 6) as mean_teu, cast(max(block_utilization_pct) > 75 as int) as is_congested,
  cast(avg(block_utilization_pct) < 30 as int) as is_underused from block_day group by yard_block)
where is_congested = 1 or is_underused = 1"""),
    "weekly_utilization": sql(FEATS + "," + BLOCK_DAY, """
select yard_block, cast(date_trunc('week', date) as date) as week, round(avg(block_utilization_pct), 6) as mean_util
from block_day group by all"""),
    "weekly_matrix": sql(FEATS + "," + BLOCK_DAY + """,
weekly as (
 select yard_block, cast(date_trunc('week', date) as date) as week, avg(block_utilization_pct) as mean_util
 from block_day group by all),
grid_ as (
 select yard_block, cast(unnest(generate_series((select min(week) from weekly), (select max(week) from weekly),
  interval 7 day)) as date) as week, avg(mean_util) as overall_util from weekly group by yard_block)""", """
select yard_block, week, round(mean_util, 6) as mean_util, round(overall_util, 6) as overall_util
from grid_ left join weekly using (yard_block, week)"""),
    "congestion_runs": sql(FEATS + "," + BLOCK_DAY + """,
marked as (
 select *, date - cast(row_number() over (partition by yard_block order by date) as int) as run
 from block_day where block_utilization_pct > 5)""", """
select yard_block, min(date) as start_date, max(date) as end_date, count(*) as days,
 round(max(block_utilization_pct), 6) as peak_util from marked group by yard_block, run having count(*) * 24 > 48"""),
    "reshuffle_hotspots": sql(FEATS + "," + BLOCK_DAY, """
select date, yard_block, avg_stack_height, block_utilization_pct from block_day
where avg_stack_height > 3.0 and block_utilization_pct > 2"""),
    "peak_utilization_events": sql(FEATS + "," + BLOCK_DAY, """
select yard_block, min(date) as peak_date, any_value(block_utilization_pct) as peak_util from (
 select *, max(block_utilization_pct) over (partition by yard_block) as top from block_day)
where block_utilization_pct = top group by yard_block"""),
    "utilization_bands": sql(FEATS + "," + PROXY, """
select yard_block, case when block_utilization_pct < 40 then 'Under-utilized' when block_utilization_pct < 65 then 'Healthy'
 when block_utilization_pct < 75 then 'High' when block_utilization_pct <= 85 then 'Congested' else 'Critical' end as band,
 count(*) as days from proxy group by all"""),
    "geometric_capacity": sql(FEATS + "," + BLOCK_DAY, """
select b.yard_block, max(teu_occupied) as peak_teu, max(b.teu_capacity) as teu_capacity,
 cast(max(yard_bays * yard_rows * max_tier) as bigint) as geometric_teu
from block_day b left join blocks using (yard_block) group by b.yard_block"""),

    "gate_hourly_peak": sql(VISITS + "," + EVENTS, """
select date, hour, gate_throughput_hr, cast(gate_throughput_hr >= (
 select quantile_cont(gate_throughput_hr, 0.8) from hourly) as int) as peak_hour_flag from hourly"""),
    "gate_mean_by_hour": sql(VISITS + "," + EVENTS, """
select hour, cast(sum(gate_throughput_hr) as double) / count(*) as mean_moves from hourly group by hour"""),
    "gate_by_direction": sql(VISITS + "," + EVENTS, """
select cast(hour(ts) as int) as hour, direction, count(*) as gate_moves from gate_events group by all"""),
    "vessel_surge": sql(FEATS, """
select cast(gate_in_time as date) as date, vessel_name, sum(teu_equivalent) as teu_equivalent, 1 as vessel_surge_flag
from feats group by cast(gate_in_time as date), vessel_name having sum(teu_equivalent) >= 8230e0 * 0.0005e0"""),
    "vessel_surge_by_block": sql(FEATS + "," + BLOCKS, """
select cast(gate_in_time as date) as date, vessel_name, yard_block, sum(teu_equivalent) as teu_equivalent,
 any_value(teu_capacity) as teu_capacity, 1 as vessel_surge_flag
from feats join blocks using (yard_block) group by cast(gate_in_time as date), vessel_name, yard_block
having sum(teu_equivalent) > any_value(teu_capacity) * 0.01"""),
    "events_hourly": """
select cast(ts as date) as date, cast(hour(ts) as int) as hour, event_type, count(*) as gate_throughput_hr
from events group by all""",
    "events_hourly_stream": """
select cast(h as date) as date, cast(hour(h) as int) as hour, n as gate_throughput_hr
from (select date_trunc('hour', ts) as h, count(*) as n from events group by date_trunc('hour', ts))""",

    "executive_kpis": sql(FEATS + "," + BLOCK_DAY, f"""
select count(*) as total_containers, {MEAN_DAYS} as avg_dwell_days,
 round(quantile_cont(dwell_days, 0.5), 6) as median_dwell_days,
 round(sum(is_overstay) / cast(count(dwell_days) as double) * 100, 6) as overstay_pct, {MONEY} as total_revenue,
 count(*) filter (where dwell_days > 30) as long_stay_count,
 (select round(max(block_utilization_pct), 6) from block_day) as peak_utilization_pct from feats"""),
    "dwell_histogram": sql(histogram(50, 60, False), histogram_rows(50, False)),
    "dwell_histogram_by_movement": sql(histogram(40, 45, True), histogram_rows(40, True)),
    "dwell_by_type": sql(FEATS, f"""
select container_type, {MEAN_DAYS} as mean_dwell, count(*) as visits,
 sum(is_overstay) / cast(count(*) as double) as overstay_rate, round(quantile_cont(dwell_days, 0.5), 6) as median_dwell
from feats where dwell_hours is not null group by container_type"""),
    "dwell_by_movement": sql(FEATS, f"""
select movement_type, {MEAN_DAYS} as mean_dwell, count(*) as visits,
 round(quantile_cont(dwell_days, 0.5), 6) as median_dwell, round(quantile_cont(dwell_days, 0.95), 6) as p95_dwell
from feats where dwell_days < 45 group by movement_type"""),
    "dwell_quartiles": sql(FEATS, """
select container_type, round(quantile_cont(dwell_days, 0.25), 6) as q1, round(quantile_cont(dwell_days, 0.5), 6) as q2,
 round(quantile_cont(dwell_days, 0.75), 6) as q3 from feats where dwell_hours is not null group by container_type"""),
    "category_breakdown": sql(FEATS, """
select dwell_category, count(*) as visits,
 count(*) / cast((select count(dwell_hours) from feats) as double) * 100 as pct
from feats where dwell_hours is not null group by dwell_category"""),
    "departure_curve": sql(FEATS + """,
minutes as (
 select dwell_s // 60 as minute, count(*) as n from feats where dwell_hours is not null group by all),
running as (select minute, sum(n) over (order by minute) as departed, sum(n) over () as total from minutes)""", """
select minute / 1440e0 as dwell_days, cast(departed as bigint) as departed,
 departed / cast(total as double) * 100 as departed_pct,
 cast(minute / 1440e0 <= (select least(60e0, quantile_cont(dwell_days, 0.99)) from feats) as int) as in_view
from running"""),
    "departure_marks": sql(FEATS, """
select cast(q * 100 as int) as pct, round(d, 6) as dwell_days from (
 select unnest([0.5, 0.75, 0.9, 0.95]) as q, unnest(quantile_cont(dwell_days, [0.5, 0.75, 0.9, 0.95])) as d from feats)"""),
    "flow_path_rank": sql(ranking("flow_path", 50), ranked_rows("flow_path")),
    "line_rank": sql(ranking("shipping_line", 100), ranked_rows("shipping_line")),
    "slowest_lines": sql(ranking("shipping_line", 100), """
select shipping_line, mean_dwell, visits from means order by mean_dwell desc, shipping_line limit 3"""),
    "feature_correlation": sql(FEATS + """,
c as (select * from feats where dwell_hours is not null)""", " union all ".join(
        f"select '{a}' as feature_a, '{b}' as feature_b, round(corr({a}, {b}), 6) as correlation from c"
        for a, b in [("dwell_hours", "teu_equivalent"), ("dwell_hours", "storage_cost_usd"),
                     ("dwell_hours", "weight_tons"), ("teu_equivalent", "storage_cost_usd"),
                     ("teu_equivalent", "weight_tons"), ("storage_cost_usd", "weight_tons")])),
    "port_comparison": sql(FEATS + f""",
ports(port, port_mean) as (values ('LA/Long Beach (truck)', 2.73e0), ('Singapore', 4.2e0), ('Hamburg', 3.7e0),
 ('LA/Long Beach (rail)', 4.98e0), ('Colombo', 7.8e0), ('Shanghai', 6.5e0), ('Rotterdam', 9.3e0), ('Antwerp', 11.4e0)),
m as (select {MEAN_DAYS} as terminal_mean from feats where movement_type = 'import')""", """
select port, port_mean, terminal_mean, round(terminal_mean - port_mean, 6) as difference_days from ports, m"""),
    "path_comparison": sql(FEATS + f""",
p as (select flow_path, {MEAN_DAYS} as mean_dwell from feats where dwell_hours is not null group by flow_path),
m as (select {MEAN_DAYS} as terminal_mean from feats)""", """
select flow_path, mean_dwell, terminal_mean, mean_dwell / terminal_mean as ratio,
 case when mean_dwell / terminal_mean > 1 then 'above' when mean_dwell / terminal_mean < 1 then 'below'
  else 'equal to' end as comparison from p, m"""),

    "revenue_impact": sql(IMPACT, """
select total_revenue, overstay_revenue, overstay_count, cast(overstay_teu as bigint) as overstay_teu,
 mean_overstay_days, round(overstay_revenue_pct, 6) as overstay_revenue_pct, opportunity_cost_daily,
 round(demurrage_daily, 6) as demurrage_daily,
 cast(opportunity_cost_daily > demurrage_daily as int) as opportunity_exceeds from impact_row"""),
    "what_if": sql(IMPACT + """,
cases(multiplier, scenario) as (values (0.7e0, '-30%'), (1.0e0, 'current'), (1.3e0, '+30%'), (1.5e0, '+50%'))""", """
select scenario, multiplier, round(85e0 * multiplier, 6) as throughput_rate,
 round(overstay_teu * (85e0 * multiplier), 6) as opportunity_cost_daily,
 case when overstay_teu * (85e0 * multiplier) > demurrage_daily then 'Exceeds' else 'Below' end as vs_demurrage
from impact_row, cases"""),
    "threshold_sensitivity": sql(FEATS + f""",
n as (
 select count(dwell_days) as closed, {MONEY} as revenue, count(*) filter (where dwell_days > 5) as five,
  count(*) filter (where dwell_days > 10) as ten from feats)""", """
select 5e0 as threshold_days, five as overstay_count, round(five / cast(closed as double) * 100, 6) as overstay_rate,
 revenue as total_revenue, cast(0 as bigint) as count_delta, 0e0 as rate_delta from n
union all select 10e0, ten, round(ten / cast(closed as double) * 100, 6), revenue, ten - five,
 round((ten - five) / cast(closed as double) * 100, 6) from n"""),
    "saved_day_value": sql(FEATS + """,
less as (
 select *, greatest(dwell_days - 1, 0) as d1, greatest(0e0, greatest(dwell_days - 1, 0) - free_days) as b1
 from feats where dwell_days is not null),
less_charge as (
 select *, cast(round_even((least(4e0, b1) * 15e0 * teu_equivalent
  + least(6e0, greatest(0e0, b1 - 4e0)) * 30e0 * teu_equivalent
  + least(11e0, greatest(0e0, b1 - 10e0)) * 55e0 * teu_equivalent
  + least(9978e0, greatest(0e0, b1 - 21e0)) * 85e0 * teu_equivalent
  + case container_type when 'reefer' then 25e0 when 'hazardous' then 18e0 else 0e0 end * d1 * teu_equivalent) * 1e6, 0)
  as bigint) as micro1 from less),
less_cents as (
 select *, micro1 // 10000 + case when micro1 % 10000 > 5000
   or (micro1 % 10000 = 5000 and (micro1 // 10000) % 2 = 1) then 1 else 0 end as cents1 from less_charge)""", """
select cast(sum(cents) as double) / 100e0 as revenue_now, cast(sum(cents1) as double) / 100e0 as revenue_one_day_less,
 sum(case when is_overstay = 1 then teu_equivalent else 0 end) * 85e0 as throughput_value_of_day,
 round(cast(sum(cents) as double) / 100e0 - cast(sum(cents1) as double) / 100e0, 2) as revenue_given_up from less_cents"""),
    "overstay_opportunity": opportunity(FEATS, "feats", "movement_type"),
    "priority_list": sql(FEATS, PRIORITY + """
 from feats where is_overstay = 1 order by storage_cost_usd desc, dwell_days desc, visit_id limit 30"""),
    "priority_list_without_overstays": sql(FEATS + """,
longest as (select * from feats where dwell_days is not null order by dwell_days desc, visit_id limit 50)""", PRIORITY + """
 from longest order by storage_cost_usd desc, dwell_days desc, visit_id limit 30"""),
    "reshuffle_cost": sql(FEATS + "," + BLOCK_DAY + """,
exits as (
 select yard_block, cast(gate_out_time as date) as date, count(*) as retrievals
 from feats where gate_out_time is not null group by all),
risk as (
 select b.yard_block, b.date, avg_stack_height as h, retrievals,
  case when avg_stack_height < 2.5 then 0.05e0 when avg_stack_height < 3.5 then 0.15e0
   when avg_stack_height < 4.5 then 0.25e0 else 0.40e0 end as lo,
  case when avg_stack_height < 2.5 then 0.10e0 when avg_stack_height < 3.5 then 0.20e0
   when avg_stack_height < 4.5 then 0.35e0 else 0.55e0 end as hi
 from block_day b join exits e on b.yard_block = e.yard_block and b.date = e.date
 where avg_stack_height is not null)""", """
select yard_block, date, round(h, 6) as avg_stack_height, retrievals, round(retrievals * lo, 6) as reshuffles_low,
 round(retrievals * hi, 6) as reshuffles_high, round(retrievals * lo * 5, 6) as cost_low_usd,
 round(retrievals * hi * 15, 6) as cost_high_usd from risk"""),

    "row_checks": sql(FAULTY + ",\n" + _row_check_parts(), "select * from result"),
    "duplicate_checks": sql(FAULTY + "," + DUPLICATES, "select * from dup_rows"),
    "clean_visits": sql(FAULTY, """
select visit_id, container_id, gate_in_time, gate_out_time, weight_tons from clean"""),
    "clean_visits_stream": sql(FAULTY, """
select visit_id, container_id, gate_in_time, gate_out_time, weight_tons from clean"""),
    "excluded_visits": sql(FAULTY, """
select visit_id, cast(is_reversed as int) as is_reversed, cast(is_future_in as int) as is_future_in,
 cast(is_future_out as int) as is_future_out from faulty where is_reversed or is_future_in or is_future_out"""),
    "invalid_values": sql(FAULTY, """
select 'movement_type' as "column", cast(1 as int) as rank, movement_type as value, count(*) as rows
from faulty where movement_type = 'INVALID_TYPE' group by movement_type"""),
    "numeric_profile": sql(VISITS, " union all ".join(
        f"select '{c}' as \"column\", count({c}) as \"count\", round(cast(min({c}) as double), 6) as min, "
        f"round(cast(max({c}) as double), 6) as max, round(avg({c}), 6) as mean, "
        f"round(cast(median({c}) as double), 6) as median, round(stddev_samp({c}), 6) as std, "
        f"round(skewness({c}), 6) as skewness from visits" for c in NUMERIC)),
    "categorical_profile": sql(VISITS + ",\n" + VALUE_COUNTS, """
select "column", cast(sum(rows) as bigint) as "count", count(*) as "unique" from value_counts group by "column" """),
    "top_values": sql(VISITS + ",\n" + VALUE_COUNTS, """
select * from (select "column", value, rows, cast(row_number() over (
 partition by "column" order by rows desc, value) as int) as rank from value_counts) where rank <= 10"""),
    "merged_numeric_profile": sql(VISITS, " union all ".join(
        f"select '{c}' as \"column\", count(*) as rows, count(*) - count({c}) as nulls, count({c}) as \"count\", "
        f"round(cast(min({c}) as double), 6) as min, round(cast(max({c}) as double), 6) as max, "
        f"round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std, round(skewness({c}), 6) as skewness, "
        f"1 as median_is_close from visits" for c in NUMERIC)),
    "merged_text_profile": sql(VISITS + ",\n" + VALUE_COUNTS, """
select "column", (select count(*) from visits) as rows, (select count(*) from visits) - n as nulls, n as "count",
 1 as unique_is_close, rank, value, rows as value_rows from (
 select "column", value, rows, cast(sum(rows) over (partition by "column") as bigint) as n, cast(row_number() over (
  partition by "column" order by rows desc, value) as int) as rank from value_counts) where rank <= 10"""),
    "merged_row_checks": sql(FAULTY + ",\n" + _row_check_parts(), "select * from result"),
    "coverage": sql(FAULTY, COVERAGE + " from clean"),
    "minimum_checks": sql(VISITS + "," + minimum_rows("visits"), "select * from min_rows"),
    "documented_checks": sql(FAULTY + """,
n as (
 select count(*) as total, count(gate_in_time) as read_in,
  count(*) filter (where date_diff('second', gate_in_time, gate_out_time) > 365 * 86400) as very_long,
  date_diff('second', min(gate_in_time), max(gate_in_time)) / 86400e0 as span,
  count(*) filter (where case substring(iso_type_code, 1, 1) when '2' then 20 when '4' then 40 when 'L' then 45 end
   <> size_ft) as wrong_size,
  count(*) filter (where case substring(iso_type_code, 3, 1) when 'G' then 'dry' when 'R' then 'reefer' when 'T' then 'tank' end
   <> container_type) as wrong_type from faulty)""", """
select 'very_long_dwell' as "check", case when very_long > 0 then 'info' else 'ok' end as level,
 'gate_out_time' as "column", 'rows' as metric, cast(very_long as double) as value from n
union all select 'read_rate', 'ok', 'gate_in_time', 'pct', round(read_in / cast(total as double) * 100, 6) from n
union all select 'containers_per_day', 'ok', 'container_id', 'mean', round(total / span, 6) from n
union all select 'iso_mismatch', case when wrong_size > 0 then 'info' else 'ok' end, 'size_ft', 'rows', wrong_size from n
union all select 'iso_mismatch', case when wrong_type > 0 then 'info' else 'ok' end, 'container_type', 'rows', wrong_type from n"""),
    "quality_status": sql(ALL_CHECKS, """
select count(*) filter (where level = 'error') as errors, count(*) filter (where level = 'warning') as warnings,
 case when count(*) filter (where level = 'error') > 0 then 'FAIL'
  when count(*) filter (where level = 'warning') > 0 then 'WARN' else 'PASS' end as status from all_checks"""),
    "stored_quality_table": sql(ALL_CHECKS, """
select "check", level, "column", metric, round(value, 6) as value from all_checks"""),
    "quality_score": sql(ALL_CHECKS, """
select round(avg(cast(level in ('ok', 'info') as int)) * 100, 6) as quality_score_pct from all_checks"""),
    "report_shares": sql(FAULTY, """
select count(*) as total_rows, (select count(*) from clean) as valid_rows,
 count(*) - (select count(*) from clean) as excluded_rows,
 (count(*) - (select count(*) from clean)) / cast(count(*) as double) * 100 as excluded_pct,
 count(*) filter (where gate_out_time is null) / cast(count(*) as double) * 100 as open_pct from faulty"""),

    "ingest_checks": sql(VISITS + """,
d as (
 select cast(split_part(visit_id, '-', 1) as bigint) as o, cast(split_part(visit_id, '-', 3) as bigint) as p, gate_out_time
 from visits)""", """
select 'total_rows' as "check", '*' as "column", cast(count(*) as double) as value from d
union all select 'domain', 'size_ft', count(*) filter (where p % 50 in (3, 4)) from d
union all select 'nulls', 'size_ft', count(*) filter (where p % 50 = 5) from d
union all select 'nulls', 'remark', count(*) filter (where p % 3 = 0) from d
union all select 'nulls', 'gate_out_time', count(*) filter (where gate_out_time is null and o % 30 <> 7) from d
union all select 'unreadable', 'gate_out_time', count(*) filter (where o % 30 = 7) from d"""),
    "missing_columns": """
select 'missing_column' as "check", 'error' as level, unnest(['size_ft', 'yard_block']) as "column"
union all select 'optional_column', 'ok', unnest(['iso_type_code', 'yard_bay', 'yard_row', 'yard_tier', 'vessel_name',
 'shipping_line', 'gate_in_mode', 'gate_out_mode'])""",
    "stored_visits": sql(VISITS + f""",
d as (
 select * replace (case when p % 50 in (3, 4, 5) then null else size_ft end as size_ft,
  case when o % 30 = 7 then null else gate_out_time end as gate_out_time)
 from (select *, cast(split_part(visit_id, '-', 1) as bigint) as o, cast(split_part(visit_id, '-', 3) as bigint) as p
  from visits)),
ordered as (select *, row_number() over (partition by container_id, gate_in_time order by visit_id) as rn from d)""", f"""
select visit_id, container_id, size_ft, gate_in_time, gate_out_time from ordered where rn = 1
 and not coalesce(gate_out_time < gate_in_time, false) and not coalesce(gate_in_time > {AS_OF}, false)
 and not coalesce(gate_out_time > {AS_OF}, false)"""),
    "stored_labels": sql(LABELLED, "select visit_id, container_id, cluster from labelled"),
    "stored_block_days": sql(FEATS + "," + BLOCK_DAY, """
select yard_block, date, container_count, teu_occupied from block_day"""),

    "scaling_statistics": sql(SCALED, "select " + ", ".join(
        f"round({c}, 6) as {c}" for c in [
            "dwell_hours__mean", "dwell_hours__std", "dwell_hours__skew", "dwell_hours__log_mean",
            "dwell_hours__log_std", "teu_equivalent__mean", "teu_equivalent__std", "storage_cost_usd__mean",
            "storage_cost_usd__std", "storage_cost_usd__skew", "storage_cost_usd__log_mean",
            "storage_cost_usd__log_std", "weight_tons__mean", "weight_tons__std"]) + " from scaling"),
    "zscore_features": sql(SCALED, """
select visit_id, round(z1, 5) as z_dwell_hours, round(z2, 5) as z_teu_equivalent,
 round(z3, 5) as z_storage_cost_usd, round(z4, 5) as z_weight_tons from scaled"""),
    "weighted_points": sql(FEATS, """
select dwell_hours, storage_cost_usd as cost, count(*) as w from feats where dwell_hours is not null
group by dwell_hours, storage_cost_usd, teu_equivalent, weight_tons"""),
    "nearest_centroid": sql(LABELLED, """
select visit_id, cluster, round(squared_distance, 5) as squared_distance from labelled"""),
    "cluster_dispersion": sql(LABELLED + """,
t as (
 select count(*) as clusters, sum(n) as rows, sum(ss) as ss, sum((s1*s1 + s2*s2 + s3*s3 + s4*s4) / n) as between_ss,
  (sum(s1)**2 + sum(s2)**2 + sum(s3)**2 + sum(s4)**2) / sum(n) as grand, min(n) as least_n, max(n) as most_n from stats)""", """
select clusters, cast(rows as bigint) as rows, round(ss - between_ss, 4) as inertia,
 round((between_ss - grand) * (rows - clusters) / ((ss - between_ss) * (clusters - 1)), 4) as calinski_harabasz,
 round(least_n / cast(rows as double) * 100, 4) as min_pct, round(most_n / cast(rows as double) * 100, 4) as max_pct from t"""),
    "davies_bouldin": sql(LABELLED + """,
means as (select cluster, s1/n as m1, s2/n as m2, s3/n as m3, s4/n as m4 from stats),
scatter as (
 select cluster, m1, m2, m3, m4, avg(sqrt((z1-m1)**2 + (z2-m2)**2 + (z3-m3)**2 + (z4-m4)**2)) as s
 from labelled join means using (cluster) group by all),
worst as (
 select a.cluster, max((a.s + b.s) / sqrt((a.m1-b.m1)**2 + (a.m2-b.m2)**2 + (a.m3-b.m3)**2 + (a.m4-b.m4)**2)) as r
 from scatter a join scatter b on a.cluster <> b.cluster group by a.cluster)""", """
select round(avg(r), 6) as davies_bouldin from worst"""),
    "silhouette_squared": sql(LABELLED + """,
sums as (
 select visit_id, l.cluster as own, s.cluster, s.n,
  s.n * (z1*z1 + z2*z2 + z3*z3 + z4*z4) - 2 * (z1*s1 + z2*s2 + z3*s3 + z4*s4) + s.ss as total
 from labelled l, stats s),
ab as (
 select visit_id, max(total / (n - 1)) filter (where own = cluster) as a, min(total / n) filter (where own <> cluster) as b
 from sums group by visit_id)""", """
select round(avg((b - a) / greatest(a, b)), 6) as silhouette_squared from ab"""),
    "segment_profiles": sql(PROFILES, """
select cluster, "count", round(mean_dwell_days, 6) as mean_dwell_days, round(median_dwell_days, 6) as median_dwell_days,
 round(mean_teu, 6) as mean_teu, round(mean_storage_cost, 6) as mean_storage_cost, dominant_movement,
 round(movement_pct, 6) as movement_pct, dominant_container_type, round(container_type_pct, 6) as container_type_pct,
 dominant_flow_path, round(overstay_pct, 6) as overstay_pct, round(teu_share_pct, 6) as teu_share_pct,
 round(revenue_share_pct, 6) as revenue_share_pct, round(empty_share, 6) as empty_share,
 round(reefer_share, 6) as reefer_share from profiles"""),
    "segment_labels": sql(NAMED, """
select cluster, base_label, label || case when empty_share > 0.6 then ' (Empties)' else '' end
 || case when reefer_share > 0.4 then ' (Reefers)' else '' end as label,
 case base_label when 'Fast Movers' then '#1D9E75' when 'Efficient Operators' then '#378ADD'
  when 'Standard Dwellers' then '#BA7517' when 'Extended Stay' then '#D85A30' when 'Overstayers' then '#E24B4A'
  else '#791F1F' end as colour from named"""),
    "segment_recommendations": sql(NAMED, f"""
select cluster, label, "count", {ADVICE} || case when round(mean_teu, 2) >= 1.5 then '{FORTY_NOTE}' else '' end as recommendation
from named"""),
    "segment_centroids": sql(LABELLED, " union all ".join(
        f"select cluster, '{name}' as feature, round(avg({z}), 5) as mean_z from labelled group by cluster"
        for name, z in [("dwell_hours", "z1"), ("teu_equivalent", "z2"),
                        ("storage_cost_usd", "z3"), ("weight_tons", "z4")])),
    "segment_radar": sql(PROFILES, " union all ".join(
        f"select cluster, '{m}' as metric, round((\"{m}\" - min(\"{m}\") over ()) / cast(max(\"{m}\") over () "
        f"- min(\"{m}\") over () as double), 6) as scaled from profiles"
        for m in ["mean_dwell_days", "mean_teu", "mean_storage_cost", "count"])),
    "segment_revenue": sql(LABELLED, f"""
select cluster, count(*) as visits, {MONEY} as revenue from labelled group by cluster"""),
    "window_segments_stored": sql(LABELLED, f"""
select l.cluster, count(*) as visits, {MONEY} as revenue
from feats f left join (select visit_id, cluster from labelled) l using (visit_id)
where cast(gate_in_time as date) between date '1998-01-01' and date '1998-06-30' group by l.cluster"""),
    "segment_revenue_by_container": sql(LABELLED, """
select l.cluster, count(*) as visits, cast(coalesce(sum(f.cents), 0) as double) / 100e0 as revenue
from feats f join labelled l using (container_id) group by l.cluster"""),
    "segment_opportunity": opportunity(LABELLED, "labelled", "cluster"),

    "clustering_sweep": sql(FEATS, """
select algorithm, cast(k as int) as k, (select count(dwell_hours) from feats) as rows, k as segments,
 1 as nearest, 1 as settled, 1 as falls from (select unnest(['KMeans', 'Hierarchical']) as algorithm), range(2, 11) r(k)"""),
    "model_metrics": sql(fixed_models(), "select algorithm, k, 'simplified_euclidean' as silhouette_metric, " + ", ".join(
        f"round({c}, 5) as {c}" for c in (
            "inertia", "calinski_harabasz", "min_pct", "max_pct", "davies_bouldin", "silhouette", "min_dwell_gap",
            "max_revenue_share")) + " from metrics"),
    "elbow_curve": sql(fixed_models(), """
select algorithm, k, round(inertia, 5) as inertia, round(silhouette, 5) as silhouette from metrics"""),
    "best_clustering": sql(fixed_models(), " union all ".join([
        best_model("default"), best_model("tie_margin", margin=0.5), best_model("strict", strict=True),
        best_model("few_segments", min_pct=99), best_model("small", max_k=3)])),
    "cargo_group_tree": sql(WARD, """
select cast(a.k as int) as k, round(sqrt(2 * b.grown), 6) as cut_height,
 round((select sum(grown) from steps c where c.step <= a.step), 6) as inertia, cast(0 as double) as leaf_inertia
from steps a join steps b on b.step = a.step + 1 where a.k between 2 and 12""", recursive=True),
    "cargo_group_silhouettes": sql(CARGO_GROUPS + """,
labels as (
 select *, 'by_reefer' as label, cast(container_type = 'reefer' as int) as c from points
 union all select *, 'by_movement', case movement_type when 'import' then 0 when 'export' then 1 else 2 end from points),
sums as (
 select a.label, a.id, a.w, a.c as own, b.c, sum(b.w) as n,
  sum(b.w * sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2)) as total
 from labels a join labels b on a.label = b.label group by all),
ab as (
 select label, id, w, max(n) filter (c = own) as own_n, max(total / (n - 1)) filter (c = own and n > 1) as a,
  min(total / n) filter (c <> own) as b from sums group by all)""", """
select label, round(sum(w * case when own_n > 1 then coalesce((b - a) / greatest(a, b), 0) else 0 end) / sum(w), 6) as silhouette,
 cast(0 as double) as silhouette_bound from ab group by label"""),
    "recommendations_by_cost": sql(NAMED + """,
cost as (""" + opportunity(LABELLED, "labelled", "cluster") + ")", """
select cluster, label, round(opportunity_cost, 4) as opportunity_cost from named join cost using (cluster)"""),

    "daily_terminal_load": sql(daily(False), "select series_id, date, value from daily"),
    "temporal_split": sql(series(True), """
select series_id, start_date, n as train_days, cast(m as int) as test_days from series"""),
    "holt_winters": sql(series(True) + HW_STEPS, curve("hw"), recursive=True),
    "simple_smoothing": sql(series(
        True, cut="|| '/' || cast((date - (select min(date) from daily)) // 13 as varchar)") + SES_STEPS, """
select series_id, model, start_date + cast(pos as int) as date, zone, actual, round(predicted, 12) as predicted
from ses""", recursive=True),
    "seasonal_moving_average": sql(series(True) + SMA_PARTS, curve("sma")),
    "forecast_accuracy": sql(series(True) + HW_STEPS + SMA_PARTS + "," + ERRORS, """
select series_id, model, round(mape, 5) as mape, round(rmse, 5) as rmse, round(mae, 5) as mae from errors""",
                             recursive=True),
    "forecast_choice": sql(series(True) + HW_STEPS + SMA_PARTS + "," + ERRORS + """,
chosen as (
 select *, row_number() over (partition by series_id order by round(mape, 2), model) as rn from errors)""", """
select series_id, model, round(mape, 2) as mape, round(rmse, 2) as rmse, round(mae, 2) as mae,
 case when round(mape, 2) < 10 then 'Excellent' when round(mape, 2) < 20 then 'Good'
  when round(mape, 2) < 30 then 'Acceptable' else 'Limited' end as quality,
 cast(round(mape, 2) > 30 as int) as is_unreliable from chosen where rn = 1""", recursive=True),
    "in_sample_accuracy": sql(series(True) + HW_STEPS, """
select series_id, model, round(avg(abs((actual - predicted) / actual)) filter (where actual <> 0) * 100, 5) as mape,
 round(sqrt(avg((actual - predicted) ** 2)), 5) as rmse, round(avg(abs(actual - predicted)), 5) as mae
from hw where zone = 'train' group by all""", recursive=True),
    "utilization_breach": sql(series(False) + HW_STEPS + """,
ahead as (
 select series_id, model, start_date + cast(pos as int) as date, predicted / 8230e0 * 100 as util
 from hw where zone = 'future'),
found as (
 select series_id, model, count(*) as horizon_days, max(util) as peak, min(date) as first_date,
  min(date) filter (where util > 2) as breach_date from ahead group by all)""", """
select series_id, model, horizon_days, round(peak, 5) as peak_forecast_util, breach_date,
 cast(breach_date - first_date + 1 as int) as days_until_breach, cast(breach_date is not null as int) as is_urgent
from found""", recursive=True),
    "optimised_holt_winters": sql(OPTIMISED, curve("optimised"), recursive=True),
    "seasonal_form_by_aic": sql(BY_AIC, """
select series_id, model, round(aic, 4) as aic from both_forms
qualify row_number() over (partition by series_id order by aic, model) = 1""", recursive=True),
    "short_series_backtest": sql(daily(True), """
select distinct series_id || '/' || cast((date - (select min(date) from daily)) // 30 as varchar) as series_id,
 1 as rows, 0 as origins, 0 as errors from daily"""),
    "one_day_series": sql(daily(True), """
select series_id || '/' || cast(date as varchar) as series_id, 'SimpleExponentialSmoothing' as model, 15 as days,
 cast(value as double) as lowest, cast(value as double) as highest
from daily where dayofmonth(date) = 1"""),
    "rolling_backtest": sql(BACKTEST, """
select series_id, origin, round(avg(abs((actual - predicted) / actual)) filter (where actual <> 0) * 100, 5) as mape,
 round(sqrt(avg((actual - predicted) ** 2)), 5) as rmse, round(avg(abs(actual - predicted)), 5) as mae
from ahead group by series_id, origin""", recursive=True),
    "smoothing_in_spans": sql(series(True).replace("daily as (", "daily as (\n select 'terminal' as series_id, date,"
        " cast(sum(teu_occupied) as double) as value from block_day group by all union all") + HW_STEPS, curve("hw"),
                              recursive=True),
    "refined_weights": sql(series(True) + grid(*GRID_VALUES) + smoothing("trials", "tried") + best_trial(
        "best", "tried") + refined(8), """
select series_id, 'HoltWinters_Optimised_Additive' as model, round(a, 6) as alpha, round(b, 6) as beta,
 round(g, 6) as gamma, round(sse, 2) as sse, round(grid_sse, 2) as grid_sse, 1 as not_worse from at_8""", recursive=True),
}
ORACLES["backtest_in_spans"] = ORACLES["rolling_backtest"]
