"""Independent SQL for DuckDB, one statement per query that SQL can express."""

from riskframe import config as C
from riskframe.functions.decision import BREAK_EVEN
from riskframe.sources.tables import DAY_ZERO

_DAY = f"date_diff('day', date '{DAY_ZERO}', cast(l_shipdate as date))"


def score_sql(dt="temp_difference_k", wt="wear_torque_min_nm", pw="power_w", parts=("heat", "overload", "power")):
    terms = {
        "heat": f"0.9*case when {dt}<8.6 then 1 else 0 end",
        "overload": f"0.00035*greatest({wt}-13000,0)",
        "power": f"0.0006*greatest({pw}-15500,0)-0.002*greatest(900-{pw},0)",
    }
    return "round(1/(1+exp(4" + "".join("-" + terms[p] for p in parts) + ")),6)"


# CTEs op (operating points), ms (machine states with labels), ss (scored states).
BASE = f"""op as (
 select md5(concat_ws('|', cast(l_orderkey as varchar), cast(l_partkey as varchar),
    cast(l_suppkey as varchar), cast(l_linenumber as varchar),
    cast(cast(round(l_extendedprice*100) as bigint) as varchar),
    cast({_DAY} as varchar))) as state_id,
  l_partkey, l_linenumber,
  case l_returnflag when 'N' then 'L' when 'R' then 'M' else 'H' end as type,
  round(295+l_discount*100,1) as air_temperature_k,
  round(303+l_discount*100+l_tax*50,1) as process_temperature_k,
  cast(floor(1150+l_extendedprice/60) as int) as rotational_speed_rpm,
  3+l_quantity*1.5 as torque_nm, cast({_DAY}%254 as int) as tool_wear_min from lineitem),
mf as (select *, round(process_temperature_k-air_temperature_k,1) as temp_difference_k,
  torque_nm*rotational_speed_rpm*2*pi()/60 as power_w,
  tool_wear_min*torque_nm as wear_torque_min_nm from op),
mc as (select *,
  case when tool_wear_min between 200 and 240 and l_linenumber=1 and l_partkey%5=0
    then 1 else 0 end as twf,
  case when temp_difference_k<8.6 and rotational_speed_rpm<1380 then 1 else 0 end as hdf,
  case when power_w<600 or power_w>17500 then 1 else 0 end as pwf,
  case when wear_torque_min_nm > case type when 'L' then 15500 when 'M' then 16500 else 17500 end
    then 1 else 0 end as osf,
  case when l_partkey%997=1 then 1 else 0 end as rnf from mf),
ms as (select *, case when twf+hdf+pwf+osf>0 then 1 else 0 end as machine_failure from mc),
ss as (select *, {score_sql()} as probability from ms)"""

# CTE sp: scored states with their split.
SPLIT = """rk as (select *, row_number() over (partition by machine_failure order by state_id) as rn,
  count(*) over (partition by machine_failure) as nc from ss),
sp as (select *, case when rn <= floor(0.15*nc+0.5) then 'test'
  when rn <= floor(0.30*nc+0.5) then 'val' else 'train' end as split from rk)"""

COST = f"cast(fn*{C.COST_FN}+fp*{C.COST_FP}+tp*{C.COST_TP} as double)"


def confusion(hit: str, y: str = "machine_failure") -> str:
    return f"""cast(count(*) filter (where {y}=1 and {hit}) as bigint) as tp,
 cast(count(*) filter (where {y}=0 and {hit}) as bigint) as fp,
 cast(count(*) filter (where {y}=1 and not ({hit})) as bigint) as fn,
 cast(count(*) filter (where {y}=0 and not ({hit})) as bigint) as tn"""


def div(num: str, den: str, digits: int = 6, empty: str = "0") -> str:
    return f"coalesce(round(({num})*1e0/nullif({den},0),{digits}),{empty})"


def ratio(num: str, den: str, digits: int = 6) -> str:
    return f"round(({num})*1e0/nullif({den},0),{digits})"


RECALL = div("tp", "tp+fn") + " as recall"
PRECISION = div("tp", "tp+fp") + " as precision"


def metrics_cte(source: str, name: str, by: str = "", threshold: float = C.THRESHOLD) -> str:
    """CTEs ending in ``name``: every metric of a scored relation, per ``by`` group."""
    part = f"partition by {by}" if by else ""
    lead = f"{by}, " if by else ""
    grp = f"group by {by}" if by else ""
    return f"""{name}_h as (select {lead}probability, count(*) as n, sum(machine_failure) as pos
 from {source} group by {lead}probability),
{name}_r as (select *, sum(n) over w as cn, sum(pos) over w as cp from {name}_h
 window w as ({part} order by probability desc rows unbounded preceding)),
{name}_a as (select {lead} cast(sum(n) as bigint) as rows, cast(sum(pos) as bigint) as failures,
 round(sum(pos*(cp*1e0/cn))/nullif(sum(pos),0),6) as pr_auc,
 round(sum((n-pos)*(cp-pos+pos/2e0))/nullif(sum(pos)*1e0*sum(n-pos),0),6) as roc_auc,
 cast(coalesce(sum(pos) filter (where probability>={threshold}),0) as bigint) as tp,
 cast(coalesce(sum(n-pos) filter (where probability>={threshold}),0) as bigint) as fp,
 cast(coalesce(sum(pos) filter (where probability<{threshold}),0) as bigint) as fn,
 cast(coalesce(sum(n-pos) filter (where probability<{threshold}),0) as bigint) as tn
 from {name}_r {grp}),
{name} as (select *, {RECALL}, {PRECISION}, {COST} as cost_eur,
 cast(failures*{C.COST_FN} as double) as do_nothing_eur,
 cast(failures*{C.COST_FN} as double)-{COST} as saving_eur from {name}_a)"""


# CTE cc: the cost curve of relation ss by its plain definition, one row per threshold.
CURVE = f"""cu as (select i, {confusion("cast(round(probability*1000000) as bigint) >= i*10000")}
  from ss, range(1,{C.GRID_STEPS + 1}) g(i) group by i),
cc as (select round(i/1e2,2) as threshold, tp, fp, fn, tn, {RECALL}, {PRECISION}, {COST} as cost_eur
  from cu),
be as (select threshold, cost_eur, recall, precision, tp, fp, fn,
  count(*) over () as tied_candidates from cc where cost_eur=(select min(cost_eur) from cc)
  qualify row_number() over (order by threshold desc)=1)"""


def metric_sql() -> dict[str, str]:
    w = f"with {BASE}"
    hit = f"probability >= {C.THRESHOLD}"
    return {
        "alarm_decision": f"{w} select state_id, probability, {hit} as alarm from ss",
        "error_kind": f"""{w} select state_id, case when machine_failure=1 and {hit} then 'TP'
 when {hit} then 'FP' when machine_failure=1 then 'FN' else 'TN' end as error_kind from ss""",
        "confusion_counts": f"""{w}, c as (select {confusion(hit)} from ss)
 select *, {RECALL}, {PRECISION} from c""",
        "expected_cost": f"""{w}, c as (select {confusion(hit)} from ss)
 select {COST} as cost_eur, cast((tp+fn)*{C.COST_FN} as double) as do_nothing_eur,
 cast((tp+fn)*{C.COST_FN} as double)-{COST} as saving_eur from c""",
        "average_precision": f"""{w}, {metrics_cte('ss', 'm')} select rows, failures, pr_auc from m""",
        "roc_auc": f"{w}, {metrics_cte('ss', 'm')} select roc_auc from m",
        "evaluate_scores": f"{w}, {metrics_cte('ss', 'm')} select * from m",
        "baseline_rules": f"""{w}, {SPLIT},
ra as (select avg(machine_failure) as rate from sp where split='train'),
bx as (select machine_failure, 'never' as rule, 0e0 as probability from sp where split='val'
 union all select machine_failure, 'random', case when
 ('0x'||substr(md5('baseline|'||state_id),1,8))::bigint/4294967296e0 < rate then 1e0 else 0e0 end
 from sp, ra where split='val'),
{metrics_cte('bx', 'm', 'rule', C.DEFAULT_THRESHOLD)}
select rule, pr_auc, roc_auc, recall, precision, cost_eur from m""",
        "score_distribution": f"""{w} select count(*) as rows, round(avg(probability),6) as mean,
 round(stddev_samp(probability),6) as std, min(probability) as min,
 round(quantile_cont(probability,0.5),6) as p50, round(quantile_cont(probability,0.9),6) as p90,
 round(quantile_cont(probability,0.95),6) as p95, round(quantile_cont(probability,0.99),6) as p99,
 max(probability) as max,
 round(avg(case when probability>={C.DEFAULT_THRESHOLD} then 1e0 else 0e0 end),6) as share_at_default,
 round(avg(case when {hit} then 1e0 else 0e0 end),6) as share_at_threshold from ss""",
        "cost_curve": f"{w}, {CURVE} select * from cc",
        "best_threshold": f"{w}, {CURVE} select * from be",
        "threshold_comparison": f"""{w}, {CURVE}, u as (
 select 'best' as rule, threshold, recall, precision, cost_eur from be union all
 select 'default', threshold, recall, precision, cost_eur from cc where abs(threshold-0.5)<0.005 union all
 select 'nothing', null, 0e0, 0e0, cast(sum(machine_failure)*{C.COST_FN} as double) from ss)
 select *, (select cost_eur from u where rule='nothing')-cost_eur as saving_eur from u""",
        "break_even": f"""{w}, {CURVE}, c as (select {confusion(f"probability >= {BREAK_EVEN!r}")} from ss)
 select round({BREAK_EVEN!r},6) as threshold, tp+fp as alarms, {RECALL}, {PRECISION},
 {COST} as cost_eur, be.threshold as best_threshold, be.cost_eur as best_cost_eur
 from (select * from c) c, (select threshold, cost_eur from be) be""",
    }


# CTE dirty: machine states with violations in the rows of every thousandth part.
DIRTY = """dirty as (select state_id, case when l_partkey%1000=7 then 'X' else type end as type,
 air_temperature_k, process_temperature_k, rotational_speed_rpm,
 case when l_partkey%1000=7 then -5e0 else torque_nm end as torque_nm,
 case when l_partkey%1000=7 then null else tool_wear_min end as tool_wear_min, machine_failure from ms)"""


def union(parts: list[str]) -> str:
    return " union all ".join(parts)


def _contract_rows(absent: str = "", text: str = "", expected: int | None = None) -> str:
    """All checks as rows; optionally of a table without a column, with a measure as text, with a row count."""
    rows, no = [], 0

    def add(check, col, severity, violations, lo="null", hi="null"):
        nonlocal no
        no += 1
        name = "null" if col is None else f"'{col}'"
        rows.append(
            f"select {no} as check_no, '{check}' as \"check\", cast({name} as varchar) as \"column\","
            f" '{severity}' as severity, cast({violations} as bigint) as violations,"
            f" cast({lo} as double) as smallest, cast({hi} as double) as largest from dirty"
        )

    for col, r in C.CONTRACT["columns"].items():
        add("present", col, "error", f"count(*)*0+{int(col == absent)}")
        if col == absent:
            continue
        add("missing", col, "error", f"count(*) filter (where {col} is null)")
        if col == text:
            add("type", col, "error", "count(*)")
        elif r["kind"] == "numeric":
            for check, sev, op in (("min", "error", "<"), ("max", "error", ">"),
                                   ("warn_min", "warning", "<"), ("warn_max", "warning", ">")):
                add(check, col, sev, f"count(*) filter (where {col} {op} {r[check]})",
                    f"min({col})", f"max({col})")
        else:
            allowed = ",".join(repr(a) for a in r["allowed"])
            add("allowed", col, "error", f"count(*) filter (where {col} not in ({allowed}))")
    if expected is not None:
        add("row_count", None, "error", f"abs(count(*)-{expected})")
    add("unexpected", None, "warning", "count(*)*0+1")
    return f"select *, violations=0 as passed from ({union(rows)})"


def _reasons() -> str:
    tests = []
    for col in C.INPUT_FIELDS:
        r = C.CONTRACT["columns"][col]
        if r["kind"] == "numeric":
            bad = f"{col} is null or {col}<{r['min']} or {col}>{r['max']}"
        else:
            bad = f"{col} is null or {col} not in ('L','M','H')"
        tests.append(f"case when {bad} then '{col}' end")
    return f"concat_ws(',', {', '.join(tests)})"


def _warnings() -> str:
    tests = []
    for col in C.MEASURES:
        r = C.CONTRACT["columns"][col]
        for op, k in (("<", "warn_min"), (">", "warn_max")):
            tests.append(f"case when {col}{op}{r[k]} then '{col}{op}{r[k]:g}' end")
    return f"concat_ws(',', {', '.join(tests)})"


def table_sql() -> dict[str, str]:
    w = f"with {BASE}"
    s = f"{w}, {SPLIT}"
    std = ", ".join(
        f"round(({c}-(select avg({c}) from op))/(select stddev_pop({c}) from op),6) as {c}"
        for c in C.MEASURES
    )
    raw = ", ".join(c for c in C.RAW_COLUMNS.values() if c not in ("udi", "product_id"))
    text = "concat_ws('|', state_id, type, cast(tool_wear_min as varchar), cast(machine_failure as varchar))"
    return {
        "raw_ingest": f"{w} select l_partkey as udi, type||cast(l_partkey as varchar) as product_id, {raw} from ms",
        "table_fingerprint": f"""{w}, h as (select md5({text}) as h from ms)
 select count(*) as rows, cast(sum(('0x'||substr(h,1,8))::bigint) as bigint) as hash_sum,
 min(h) as hash_min, max(h) as hash_max from h""",
        "split_store": f"{s} select state_id, machine_failure, split from sp where split='test'",
        "reference_sample": f"""{s} select state_id, {", ".join(C.INPUT_FIELDS)}, machine_failure, probability
 from sp where split='val' order by md5('{C.SEED}|'||state_id), state_id limit {C.SAMPLE_SIZE}""",
        "drop_leakage": f"{w} select state_id, {', '.join(C.INPUT_FIELDS)}, machine_failure from ms",
        "engineered_features": f"""{w} select state_id,
 round(process_temperature_k-air_temperature_k,4) as temp_difference_k,
 round(torque_nm*rotational_speed_rpm*2*pi()/60,4) as power_w,
 round(tool_wear_min*torque_nm,4) as wear_torque_min_nm from op""",
        "one_hot": f"""{w} select state_id, type, case when type='L' then 1e0 else 0e0 end as "type_L",
 case when type='M' then 1e0 else 0e0 end as "type_M" from op""",
        "standardize": f"{w} select state_id, {std} from op",
        "contract_report": f"{w}, {DIRTY} {_contract_rows()}",
        "contract_summary": f"""{w}, {DIRTY}, r as ({_contract_rows()}), f as (
 select *, "check"||coalesce(':'||"column",'') as nm from r)
 select count(*) as checks_run,
 cast(count(*) filter (where not passed and severity='error') as bigint) as errors,
 cast(count(*) filter (where not passed and severity='warning') as bigint) as warnings,
 coalesce(string_agg(nm,',' order by nm) filter (where not passed and severity='error'),'') as failed_checks,
 coalesce(string_agg(nm,',' order by nm) filter (where not passed and severity='warning'),'') as warned_checks,
 count(*) filter (where not passed and severity='error')=0 as valid from f""",
        "contract_categories": f"""{w}, {DIRTY} select 'type' as "column", type as value, count(*) as rows
 from dirty where type not in ('L','M','H') group by type""",
        "quarantine_split": f"""{w}, {DIRTY} select state_id, {_reasons()} as reject_reasons,
 {_reasons()}='' as accepted from dirty""",
        "row_warnings": f"{w}, {DIRTY} select state_id, {_warnings()} as warnings from dirty where {_warnings()}<>''",
        "json_field_check": """select event_id,
 coalesce((select string_agg(x,',' order by x) from unnest(json_keys(props)) u(x) where x not in ('k','unit')),'')
  as unknown_fields,
 concat_ws(',', case when not list_contains(json_keys(props),'k') then 'k' end,
  case when not list_contains(json_keys(props),'unit') then 'unit' end) as missing_fields,
 len(json_keys(props))=2 and list_contains(json_keys(props),'k') and list_contains(json_keys(props),'unit')
  as accepted from events""",
        "stratified_split": f"{s} select state_id, machine_failure, split from sp",
        "split_overview": f"""{s} select split, count(*) as rows,
 round(count(*)*1e0/(select count(*) from sp),6) as share, cast(sum(machine_failure) as bigint) as failures,
 round(sum(machine_failure)*1e0/count(*),6) as failure_rate from sp group by split""",
        "split_overlap": f"""{s}, k as (select state_id, split from sp group by all) select
 (select count(*) from sp) as rows, (select count(distinct state_id) from sp) as keys,
 (select count(*) from (select state_id from k where split='train' intersect select state_id from k where split='val')) as train_val,
 (select count(*) from (select state_id from k where split='train' intersect select state_id from k where split='test')) as train_test,
 (select count(*) from (select state_id from k where split='val' intersect select state_id from k where split='test')) as val_test,
 0 as forbidden_columns""",
        "contract_broken": f"{w}, {DIRTY} " + _contract_rows("tool_wear_min", "torque_nm", C.CONTRACT["expected_row_count"]),
        "split_changed": f"""{s}, a as (select state_id, machine_failure, split from sp),
 b as (select state_id, machine_failure, case when rn<=floor(0.2*nc+0.5) then 'test' when rn<=floor(0.35*nc+0.5) then 'val' else 'train' end as split from rk)
 select (select count(*) from (from a except all from b)) as only_stored,
 (select count(*) from (from b except all from a)) as only_recomputed, false as reproduced""",
        "split_reproducible": f"""{s}, a as (select state_id, machine_failure, split from sp) select
 (select count(*) from (from a except all from a)) as only_stored,
 (select count(*) from (from a except all from a)) as only_recomputed, true as reproduced""",
        "uniform_sample": f"""{w} select state_id, type, machine_failure from ms
 order by md5('{C.SEED}|'||state_id), state_id limit {C.SAMPLE_SIZE}""",
        "stratified_folds": f"""{s}, f as (select state_id, machine_failure,
 row_number() over (partition by machine_failure order by md5('fold{C.SEED}|'||state_id)) as r,
 count(*) over (partition by machine_failure) as n from sp where split='train')
 select state_id, machine_failure, case when r<=floor(0.2*n+1e-9) then 0 when r<=floor(0.4*n+1e-9) then 1
 when r<=floor(0.6*n+1e-9) then 2 when r<=floor(0.8*n+1e-9) then 3 else 4 end as fold from f""",
        "val_test_gap": f"""{s}, {metrics_cte("sp", "m", "split")},
 u as ({union([f"select split, '{m}' as metric, cast({m} as double) as value from m"
               for m in ("pr_auc", "roc_auc", "recall", "precision", "cost_eur")])})
 select metric, max(value) filter (where split='val') as val, max(value) filter (where split='test') as test,
 round(max(value) filter (where split='val')-max(value) filter (where split='test'),6) as gap
 from u where split<>'train' group by metric""",
        "column_profile": f"{w}, {DIRTY} " + union([
            f"select '{c}' as \"column\", '{t}' as type, count(*)-count({c}) as missing,"
            f" count(distinct {c}) as distinct_values from dirty"
            for c, t in {
                "state_id": "string", "type": "string", "air_temperature_k": "double",
                "process_temperature_k": "double", "rotational_speed_rpm": "int",
                "torque_nm": "double", "tool_wear_min": "int", "machine_failure": "int",
            }.items()
        ]),
        "describe_numeric": f"{w} " + union([
            f"""select '{c}' as "column", count({c}) as count, round(avg({c}),2) as mean,
 round(stddev_samp({c}),2) as std, round(cast(min({c}) as double),2) as min,
 round(quantile_cont({c},0.25),2) as p25, round(quantile_cont({c},0.5),2) as p50,
 round(quantile_cont({c},0.75),2) as p75, round(cast(max({c}) as double),2) as max from ms"""
            for c in [*C.MEASURES, *C.ENGINEERED]
        ]),
        "class_balance": f"""{w}, c as (select machine_failure, count(*) as rows from ms group by 1)
 select *, round(rows*1e0/sum(rows) over (),6) as share,
 round(max(rows) over ()*1e0/sum(rows) over (),6) as trivial_accuracy from c""",
        "class_histogram": f"{w} " + union([
            f"""select '{c}' as "column", machine_failure, bin, rows,
 round(rows/(sum(rows) over (partition by machine_failure)*wd),6) as density from (
 select machine_failure, cast(least(floor(({c}-lo)/wd),38) as int) as bin, any_value(wd) as wd, count(*) as rows
 from ms, (select min({c})*1e0 as lo, (max({c})*1e0-min({c})*1e0)/39 as wd from ms) group by 1,2)"""
            for c in C.MEASURES
        ]),
        "failure_rate_by_type": f"""{w} select case type when 'L' then 1 when 'M' then 2 else 3 end as order_no,
 type, count(*) as rows, cast(sum(machine_failure) as bigint) as failures,
 round(sum(machine_failure)*1e0/count(*),6) as failure_rate from ms group by type""",
        "correlation_matrix": f"{w} " + union([
            f"select '{a}' as \"column\", " + ", ".join(
                f"1e0 as {b}" if a == b else f"round(corr({a},{b}),6) as {b}"
                for b in [*C.MEASURES, C.TARGET]
            ) + " from ms"
            for a in [*C.MEASURES, C.TARGET]
        ]),
        "leakage_audit": f"{w} " + union([
            f"""select '{c}' as "column", cast(sum({c}) as bigint) as cases, round(corr({c},machine_failure),6)
 as correlation, cast(sum(machine_failure) as bigint) as failures,
 count(*) filter (where twf+hdf+pwf+osf+rnf>0 and machine_failure=1) as explained from ms"""
            for c in C.CAUSES
        ]),
        "cause_multiplicity": f"""{w} select twf+hdf+pwf+osf+rnf as causes, count(*) as rows,
 cast(sum(twf+hdf+pwf+osf+rnf) as bigint) as marks, cast(sum(machine_failure) as bigint) as failures
 from ms group by 1""",
        "cause_crosstab": f"""{w} select machine_failure=1 as failure,
 count(*) filter (where twf+hdf+pwf+osf+rnf=0) as without_cause,
 count(*) filter (where twf+hdf+pwf+osf+rnf>0) as with_cause from ms group by 1""",
        "cause_hit_rate": f"{w} " + union([
            f"""select '{c}' as cause, cast(sum({c}) as bigint) as marked,
 count(*) filter (where {c}=1 and machine_failure=1) as failed,
 round(count(*) filter (where {c}=1 and machine_failure=1)*100e0/nullif(sum({c}),0),1) as hit_rate from ms"""
            for c in C.CAUSES
        ]),
        "key_uniqueness": " union all ".join(
            f"""select '{n}' as key, cast(sum(c) as bigint) as rows, count(*) as distinct_keys,
 max(c) as largest_group, sum(c)=count(*) as is_unique from (select count(*) as c from lineitem group by {k})"""
            for n, k in (("order", "l_orderkey"), ("order_line", "l_orderkey, l_linenumber"))
        ),
        "box_stats": f"{w} " + union([
            f"""select '{c}' as "column", {k} as class, round(min({c}) filter (where {c}>=lo and {c}<=hi),4) as whisker_low,
 round(any_value(q1),4) as p25, round(any_value(q2),4) as p50, round(any_value(q3),4) as p75,
 round(max({c}) filter (where {c}>=lo and {c}<=hi),4) as whisker_high from ms,
 (select q1,q2,q3,q1-1.5*(q3-q1) as lo,q3+1.5*(q3-q1) as hi from (select quantile_cont({c},0.25) as q1,
 quantile_cont({c},0.5) as q2, quantile_cont({c},0.75) as q3 from ms where machine_failure={k}))
 where machine_failure={k}"""
            for c in ("temp_difference_k", "power_w") for k in (0, 1)
        ]),
        "quantile_bands": f"{w}, {BAND_EDGES} " + union([
            f"""select '{c}' as "column", b as band_no, count(*) as rows, round(cast(min(v) as double),6) as smallest,
 round(cast(max(v) as double),6) as largest,
 any_value(case when hi-lo<50 then format('{{:.1f}}–{{:.1f}}', e[b], e[b+1])
 else format('{{:.0f}}–{{:.0f}}', e[b], e[b+1]) end) as label from (
 select {c} as v, {band_sql(c)} as b, e_{c} as e, e_{c}[1] as lo, e_{c}[-1] as hi from ms, be) group by b"""
            for c in BANDED
        ]),
    }


BANDED = ["tool_wear_min", "torque_nm", "rotational_speed_rpm", "temp_difference_k", "power_w"]

# CTE be: per banded column the sorted distinct quartile edges, as lists in one row.
BAND_EDGES = "be as (select " + ", ".join(
    f"(select list(distinct round(x,9) order by round(x,9)) from (select unnest(quantile_cont(cast({c} as double),"
    f"[0,0.25,0.5,0.75,1])) as x from ms)) as e_{c}"
    for c in BANDED
) + ")"


def band_sql(c: str) -> str:
    return f"cast(1+len(list_filter(e_{c}[2:len(e_{c})-1], lambda z: {c}>z)) as int)"


# ---- slicing --------------------------------------------------------------------------------

SLICE_BANDS = {
    "wear_band": "tool_wear_min", "torque_band": "torque_nm", "speed_band": "rotational_speed_rpm",
    "temp_difference_band": "temp_difference_k", "power_band": "power_w",
}
_EDGES = ", ".join(
    f"(select list(distinct round(x,9) order by round(x,9)) from (select unnest(quantile_cont(cast({c} as double),"
    f"[0,0.25,0.5,0.75,1])) as x from va)) as e_{c}"
    for c in SLICE_BANDS.values()
)
_LABELS = "".join(
    f", case when e_{c}[-1]-e_{c}[1]<50 then format('{{:.1f}}–{{:.1f}}', e_{c}[{n}], e_{c}[{n}+1])"
    f" else format('{{:.0f}}–{{:.0f}}', e_{c}[{n}], e_{c}[{n}+1]) end as l_{n}"
    for n, c in SLICE_BANDS.items()
)
# CTEs va (validation rows), sl (rows with band numbers n), lb (with labels), lv (slice long form).
SLICES = f"""va as (select * from sp where split='val'), be as (select {_EDGES}),
sl as (select va.*, be.*, case type when 'L' then 1 when 'M' then 2 else 3 end as type_no, {", ".join(f"{band_sql(c)} as {n}" for n, c in SLICE_BANDS.items())},
 probability>={C.THRESHOLD} as hit from va, be),
lb as (select *{_LABELS} from sl),
lv as (select 'type' as slice, type_no as value_no, type as value, machine_failure, hit from lb union all
 {" union all ".join(f"select '{n}', {n}, l_{n}, machine_failure, hit from lb" for n in SLICE_BANDS)})"""

_OUT = """cast(count(*) as bigint) as rows, cast(count(*) filter (where machine_failure=1 and hit) as bigint) as tp,
 cast(count(*) filter (where machine_failure=0 and hit) as bigint) as fp,
 cast(count(*) filter (where machine_failure=1 and not hit) as bigint) as fn"""
_SLICE = f"""tp+fn as failures, {ratio("tp+fn", "rows")} as failure_rate, {ratio("tp", "tp+fn")} as recall,
 {ratio("tp", "tp+fp")} as precision,
 case when tp>0 then round(2*(tp*1e0/(tp+fp))*(tp*1e0/(tp+fn))/(tp*1e0/(tp+fp)+tp*1e0/(tp+fn)),6) end as f1,
 {COST} as cost_eur"""


def slice_sql() -> dict[str, str]:
    s = f"with {BASE}, {SPLIT}, {SLICES}"
    table = f"""t as (select slice, value_no, value, {_OUT} from lv group by all),
m as (select *, {_SLICE} from t),
sm as (select *, round(coalesce(cost_eur/nullif(sum(cost_eur) over (partition by slice),0),0),6) as cost_share from m)"""
    crosses = []
    for a, b in (("type", "wear_band"), ("torque_band", "speed_band"), ("temp_difference_band", "speed_band")):
        an = "type_no" if a == "type" else a
        av = "type" if a == "type" else f"l_{a}"
        cells = ", ".join(
            f"max(case when b={i} and rows>=50 then r end) as recall_{i}" for i in range(1, 6)
        ) + ", " + ", ".join(f"max(case when b={i} then rows end) as rows_{i}" for i in range(1, 6))
        crosses.append(
            f"select '{a} x {b}' as pair, a as row_no, any_value(v) as row_value, {cells} from ("
            f"select {an} as a, {av} as v, {b} as b, count(*) as rows,"
            f" round(count(*) filter (where machine_failure=1 and hit)*1e0/nullif(sum(machine_failure),0),6) as r"
            f" from lb group by all) group by a"
        )
    causes = [(c, f"{c}=1") for c in C.CAUSES] + [("none recorded", "twf+hdf+pwf+osf+rnf=0")]
    by_cause = union([
        f"""select '{n}' as cause, count(*) as failures, count(*) filter (where hit) as found,
 round(avg(probability),6) as mean_probability, count(*) filter (where not hit) as missed,
 round(count(*) filter (where hit)*1e0/nullif(count(*),0),6) as recall from sl where machine_failure=1 and {w}"""
        for n, w in causes
    ])
    return {
        "attach_causes": f"with {BASE}, {SPLIT} select state_id, probability, machine_failure, twf, hdf, pwf, osf, rnf from sp where split='val'",
        "slice_metrics": f"{s}, {table} select * from sm",
        "overall_metrics": f"{s}, t as (select {_OUT} from sl) select *, {_SLICE} from t",
        "metrics_by_cause": f"{s} select * from ({by_cause}) where cause<>'none recorded' or failures>0",
        "cross_metrics": f"{s} {union(crosses)}",
        "worst_slices": f"""{s}, {table}, g as (select *, round(tp*1e0/(tp+fn)
 -(select count(*) filter (where hit)*1e0/count(*) from sl where machine_failure=1),6) as recall_gap from sm
 where rows>=50 and failures>0)
 select slice, value_no, value, rows, failures, recall, recall_gap, fn, cost_eur, cost_share from g
 order by recall_gap, slice, value_no limit {C.WORST_SLICES}""",
        "document_quality_by_language": """select case lang when 'de' then 1 when 'en' then 2 when 'es' then 3 else 4 end
 as order_no, lang, count(*) as rows, cast(sum(quality) as bigint) as failures,
 round(sum(quality)*1e0/count(*),6) as failure_rate from documents join labels using (doc_id)
 where lang in ('de','en','es','fr') group by lang""",
    }


# ---- drift ----------------------------------------------------------------------------------

# CTEs pr (reference half) and pc (current half, shifted) of the scored states.
PAIR = f"""pr as (select state_id, {", ".join(C.INPUT_FIELDS)}, machine_failure, probability from ss where state_id<'8'),
pc0 as (select state_id, case when l_linenumber>=4 then 'H' else type end as type, air_temperature_k,
 process_temperature_k+3e0 as process_temperature_k, rotational_speed_rpm, torque_nm, tool_wear_min from op where state_id>='8'),
pc1 as (select *, round(process_temperature_k-air_temperature_k,1) as temp_difference_k,
 torque_nm*rotational_speed_rpm*2*pi()/60 as power_w, tool_wear_min*torque_nm as wear_torque_min_nm from pc0),
pc as (select state_id, {", ".join(C.INPUT_FIELDS)}, 0 as machine_failure, {score_sql()} as probability from pc1)"""
# the unshifted pair
EVEN = """pr as (select * from ss where state_id<'8'), pc as (select * from ss where state_id>='8')"""

VERDICT = "case when psi is null then 'unknown' when psi>=0.25 then 'act' when psi>=0.1 then 'watch' else 'stable' end"
_DECILES = "[" + ",".join(str(i / 10) for i in range(11)) + "]"


def psi_term(r: str, a: str) -> str:
    r, a = f"greatest({r},1e-6)", f"greatest({a},1e-6)"
    return f"({a}-{r})*ln({a}/{r})"


def numeric_drift(cols: list[str], extra: str = "") -> str:
    """CTEs lg, ed, bn, ps (PSI and means), ks (distance), kp (p-value) over pr and pc."""
    long = union([
        f"select '{c}' as feature, cast({c} as double) as v, {r} as r from {t}"
        for c in cols for t, r in (("pr", 1), ("pc", 0))
    ])
    lam = "sqrt(nr*1e0*nc/(nr+nc))*d"
    large = "+".join(f"({2 * (-1) ** (k - 1)})*exp(-2e0*{k * k}*l*l)" for k in range(1, 20))
    small = "+".join(f"exp(-{(2 * k - 1) ** 2}*pi()*pi()/(8*l*l))" for k in range(1, 8))
    return f"""lg as ({long}),
ed as (select feature, list(distinct round(x,9) order by round(x,9)) as e from (
 select feature, unnest(quantile_cont(v,{_DECILES})) as x from lg where r=1 group by feature) group by feature),
bn as (select feature, len(list_filter(e[2:len(e)-1], lambda z: v>=z)) as b, sum(r) as nr, sum(1-r) as nc
 from lg join ed using (feature) where v is not null group by all),
tt as (select feature, sum(r) as nr, sum(1-r) as nc, avg(v) filter (where r=1) as mr, avg(v) filter (where r=0) as mc
 from lg where v is not null group by feature),
ps as (select feature, sum({psi_term("bn.nr/tt.nr", "bn.nc/tt.nc")}) as psi, any_value(mr) as mr, any_value(mc) as mc,
 any_value(tt.nr) as nr, any_value(tt.nc) as nc from bn join tt using (feature) group by feature),
ks as (select feature, max(abs(cr*1e0/nr-cc*1e0/nc)) as d from (select feature, sum(a) over w as cr, sum(b) over w as cc
 from (select feature, v, sum(r) as a, sum(1-r) as b from lg where v is not null group by feature, v)
 window w as (partition by feature order by v rows unbounded preceding)) join tt using (feature) group by feature),
kl as (select feature, d, {lam} as l from ks join tt using (feature)),
kp as (select feature, d, case when l<=1e-3 then 1e0 when l<1 then 1-sqrt(2*pi())/l*({small})
 else greatest({large},0) end as p from kl)"""


# CTEs ct (counts per type), cp (PSI), ch (chi-square and p-value at two degrees of freedom).
CATEGORY = f"""ct as (select type as c, sum(r) as nr, sum(1-r) as nc from (select type, 1 as r from pr union all
 select type, 0 from pc) where type is not null group by type),
cp as (select sum({psi_term("nr/(select sum(nr) from ct)", "nc/(select sum(nc) from ct)")}) as psi,
 sum(nr) as nr, sum(nc) as nc from ct),
ce as (select nr, nc, (nr+nc)*(sum(nr) over ())/(sum(nr+nc) over ()) as er, (nr+nc)*(sum(nc) over ())/(sum(nr+nc) over ()) as ec from ct),
ch as (select sum((nr-er)*(nr-er)/er+(nc-ec)*(nc-ec)/ec) as x, count(*)-1 as dof from ce)"""

_TABLE = f"""dt as (select feature, round(psi,4) as psi, {VERDICT} as verdict, 'KS' as test, round(d,4) as statistic,
 round(p,6) as p_value, p<{C.ALPHA} as significant, round(mr,3) as ref_mean, round(mc,3) as cur_mean,
 len(e)<3 as degenerate_reference from ps join kp using (feature) join ed using (feature) where feature<>'probability'
 union all select 'type', round(psi,4), {VERDICT}, 'chi2', round(x,4), round(exp(-x/2),6), exp(-x/2)<{C.ALPHA}, null, null,
 false from cp, ch),
om as (select {C.THRESHOLD} as threshold, round(psi,4) as prediction_psi, {VERDICT} as prediction_verdict,
 (select round(avg(case when probability>={C.THRESHOLD} then 1e0 else 0e0 end),4) from pr) as alarm_rate_reference,
 (select round(avg(case when probability>={C.THRESHOLD} then 1e0 else 0e0 end),4) from pc) as alarm_rate_current,
 round(mr,4) as mean_probability_reference, round(mc,4) as mean_probability_current from ps where feature='probability')"""

# CTE lo: the prediction log.
LOG = """lo as (select event_id as id, ts, cast(user_id as varchar)||'-'||cast(cast(ts as date) as varchar) as request_id,
 cast(row_number() over (partition by user_id, cast(ts as date) order by event_id)-1 as int) as row_no,
 round(least(value/500e0,1e0),6) as probability, round(least(value/500e0,1e0),6)>=0.06 as alarm,
 cast(0.06 as double) as threshold, round(value,3) as latency_ms, event_type='error' as failed,
 cast(json_extract_string(props,'$.k') as int) as k, props as inputs from events)"""


def _runs_sql() -> str:
    """CTE dp: PSI of each day after the tenth against the first ten days, per feature."""
    long = union([f"select day, '{c}' as feature, cast({c} as double) as v from dl" for c in ("probability", "latency_ms", "k")])
    return f"""{LOG}, dl as (select cast(ts as date) as day, probability, k,
 case when cast(ts as date) between date '2024-01-14' and date '2024-01-15'
  or cast(ts as date) between date '2024-01-20' and date '2024-01-27' then latency_ms*2 else latency_ms end as latency_ms from lo),
lg as ({long}),
ed as (select feature, list(distinct round(x,9) order by round(x,9)) as e from (select feature,
 unnest(quantile_cont(v,{_DECILES})) as x from lg where day<=date '2024-01-10' group by feature) group by feature),
bx as (select day, feature, len(list_filter(e[2:len(e)-1], lambda z: v>=z)) as b from lg join ed using (feature)),
rb as (select feature, b, count(*)*1e0/sum(count(*)) over (partition by feature) as s from bx
 where day<=date '2024-01-10' group by feature, b),
cb as (select day, feature, b, count(*) as n, sum(count(*)) over (partition by day, feature) as t from bx
 where day>date '2024-01-10' group by day, feature, b),
gr as (select distinct day, feature, rb.b, s from (select distinct day, feature from cb) join rb using (feature)),
dp as (select day as run, feature, sum({psi_term("gr.s", "coalesce(cb.n,0)/(select max(t) from cb c2 where c2.day=gr.day and c2.feature=gr.feature)")}) as psi
 from gr left join cb using (day, feature, b) group by day, feature),
pd as (select run, feature, round(psi,4) as psi, {VERDICT} as verdict, case when count(*) over w<3 then 'stable'
 when min(psi) over w>=0.25 then 'act' when min(psi) over w>=0.1 then 'watch' else 'stable' end as persistent_verdict
 from dp window w as (partition by feature order by run rows between 2 preceding and current row))"""


def _importance_sql() -> str:
    """CTE im: average precision lost per permuted feature, on the reference half."""
    cols = [*C.MEASURES, "l_linenumber"]
    given = ", ".join(cols)
    variants = union([f"select 'none permuted' as f, machine_failure, {given} from px"] + [
        f"select '{f}', machine_failure, " + ", ".join(f"o_{c} as {c}" if c == f else c for c in cols) + " from px"
        for f in cols
    ])
    lag = ", ".join(f"coalesce(lag({c}) over w, last_value({c}) over (partition by lot order by h, state_id"
                    f" rows between unbounded preceding and unbounded following)) as o_{c}" for c in cols)
    return f"""ph as (select *, md5('permutation|'||state_id) as h from ss where state_id<'8'),
pl as (select *, ('0x'||substr(h,1,8))::bigint % 8 as lot from ph),
px as (select machine_failure, {given}, {lag} from pl window w as (partition by lot order by h, state_id)),
pv as ({variants}),
pw as (select *, round(process_temperature_k-air_temperature_k,1) as temp_difference_k,
 torque_nm*rotational_speed_rpm*2*pi()/60 as power_w, tool_wear_min*torque_nm as wear_torque_min_nm from pv),
pq as (select f, machine_failure, {score_sql()} as probability from pw),
{metrics_cte("pq", "pm", "f")},
pa as (select f, sum(pos*(cp*1e0/cn))/sum(pos) as ap from pm_r group by f),
im as (select f as feature, round(ap,6) as pr_auc, round((select ap from pa where f='none permuted')-ap,6) as importance
 from pa where f<>'none permuted')"""


def _contributing_sql() -> str:
    cols = [*C.MEASURES, "l_linenumber"]
    edges = union([
        f"select '{c}' as feature, list(distinct round(x,9) order by round(x,9)) as e from"
        f" (select unnest(quantile_cont({c},{_DECILES})) as x from ss where state_id<'8')" for c in cols
    ])
    moved = {"l_linenumber": "case when run in ('8','9','a','b') then l_linenumber+4 else l_linenumber end",
             "tool_wear_min": "case when run in ('c','d','e','f') then tool_wear_min+60 else tool_wear_min end"}
    long = union([
        f"select run, '{c}' as feature, cast({moved.get(c, c)} as double) as v from (select *, case when state_id<'8' then 'ref'"
        f" else substr(state_id,1,1) end as run from ss)" for c in cols
    ])
    return f"""with {BASE}, {_importance_sql()}, ce as ({edges}), cl as ({long}),
cb as (select run, feature, len(list_filter(e[2:len(e)-1], lambda z: v>=z)) as b, count(*) as n from cl join ce using (feature) group by all),
cs as (select run, feature, b, n*1e0/sum(n) over (partition by run, feature) as s from cb),
cp as (select r.run, c.feature, sum({psi_term("coalesce(c.s,0)", "coalesce(x.s,0)")}) as psi
 from (select distinct run from cs where run<>'ref') r cross join (select * from cs where run='ref') c
 left join cs x on x.run=r.run and x.feature=c.feature and x.b=c.b group by all),
cw as (select run, feature, case when count(*) over w=3 then min(psi) over w end as held
 from cp window w as (partition by feature order by run rows between 2 preceding and current row)),
cj as (select run, feature, coalesce(held>=0.25, false) as acting, importance>={C.LEAST_IMPORTANCE} as relied from cw join im using (feature))
select run, coalesce(string_agg(feature, ',' order by feature) filter (where acting and relied), '') as contributing,
 coalesce(string_agg(feature, ',' order by feature) filter (where acting and not relied), '') as other,
 bool_or(acting and relied) as retrain from cj group by run"""


def _scenario_ctes(torque: dict[str, str] | None = None) -> str:
    """CTE st: the scenario table by running every scenario on its own; ``torque`` are further ones."""
    torque = torque or {}
    variants = {
        "control": ("type", "process_temperature_k", "tool_wear_min"),
        "temperature_calibration": ("type", "process_temperature_k+3e0", "tool_wear_min"),
        "high_wear": ("type", "process_temperature_k", "tool_wear_min+60"),
        "type_shift": (
            "case when row_number() over (order by state_id)<=floor(0.8*(select count(*) from pc)) then 'H' else type end",
            "process_temperature_k", "tool_wear_min",
        ),
        **{n: ("type", "process_temperature_k", "tool_wear_min") for n in torque},
    }
    rows = union([
        f"""select '{n}' as scenario, machine_failure, {t} as type, air_temperature_k, {p} as process_temperature_k,
 rotational_speed_rpm, {torque.get(n, "torque_nm")} as torque_nm, {w} as tool_wear_min from pc""" for n, (t, p, w) in variants.items()
    ])
    cols = [*C.MEASURES, C.PROBABILITY]
    ref = union([f"select '{c}' as feature, cast({c} as double) as v from pr" for c in cols])
    cur = union([f"select scenario, '{c}' as feature, cast({c} as double) as v from sv" for c in cols])
    return f"""sa as ({rows}), sb as (select *, round(process_temperature_k-air_temperature_k,1) as temp_difference_k,
 torque_nm*rotational_speed_rpm*2*pi()/60 as power_w, tool_wear_min*torque_nm as wear_torque_min_nm from sa),
sv as (select *, {score_sql()} as probability from sb),
rl as ({ref}), cl as ({cur}),
ed as (select feature, list(distinct round(x,9) order by round(x,9)) as e from (select feature,
 unnest(quantile_cont(v,{_DECILES})) as x from rl group by feature) group by feature),
rb as (select feature, cast(len(list_filter(e[2:len(e)-1], lambda z: v>=z)) as varchar) as b, count(*) as n
 from rl join ed using (feature) group by all union all select 'type', type, count(*) from pr group by type),
cb as (select scenario, feature, cast(len(list_filter(e[2:len(e)-1], lambda z: v>=z)) as varchar) as b, count(*) as n
 from cl join ed using (feature) group by all union all select scenario, 'type', type, count(*) from sv group by all),
al as (select scenario, feature, b, 0 as nr, n as nc from cb union all
 select scenario, feature, b, n, 0 from rb, (select distinct scenario from sv)),
ag as (select scenario, feature, b, sum(nr) as nr, sum(nc) as nc from al group by all),
sp2 as (select scenario, feature, psi, {VERDICT} as v from (select scenario, feature,
 sum({psi_term("nr/(select count(*) from pr)", "nc/(select count(*) from pc)")}) as psi from ag group by all)),
so as (select scenario, {confusion(f"probability>={C.THRESHOLD}")} from sv group by scenario),
sd as (select scenario, case when bool_or(v='act') then 'act' when bool_or(v='watch') then 'watch' else 'stable' end as verdict,
 max(round(psi,4)) filter (where feature<>'probability') as max_psi,
 first(feature order by round(psi,4) desc, feature) filter (where feature<>'probability') as max_psi_feature,
 max(round(psi,4)) filter (where feature='probability') as prediction_psi,
 max(v) filter (where feature='probability') as prediction_verdict from sp2 group by scenario),
st as (select sd.*, {div("tp+fp", "tp+fp+fn+tn", 4)} as alarm_rate, {div("tp", "tp+fn", 4)} as recall,
 {div("tp", "tp+fp", 4)} as precision, {COST} as cost_eur from sd join so using (scenario)),
ctl as (select alarm_rate as ca, recall as cr, cost_eur as cc from st where scenario='control')"""


def drift_sql() -> dict[str, str]:
    cols = [*C.MEASURES, C.PROBABILITY]
    w = f"with {BASE}, {PAIR}, {numeric_drift(cols)}"
    full = f"{w}, {CATEGORY}, {_TABLE}"
    overall = f"""{full}, v as (select verdict from dt union all select prediction_verdict from om) select
 (select count(*) from pr) as reference_rows, (select count(*) from pc) as current_rows,
 (select count(*) from pc)>={C.MIN_ROWS} as enough_data,
 case when (select count(*) from pc)<{C.MIN_ROWS} then 'too little data' when (select bool_or(verdict='act') from v) then 'act'
 when (select bool_or(verdict='watch') from v) then 'watch' else 'stable' end as verdict,
 (select prediction_verdict from om) as prediction_verdict, {", ".join(
     f"(select count(*) from dt where verdict='{x}') as {x}" for x in ("act", "watch", "unknown"))}"""
    sc = f"with {BASE}, {EVEN}, {_scenario_ctes()}"
    uneven = {"uneven_torque": "case when type='L' then torque_nm*0.85e0 else torque_nm*1.03e0 end"}
    silent = """ select scenario, alarm_rate, recall, round(cr-recall,4) as recall_drop, max_psi, prediction_psi
 from st, ctl where scenario<>'control' and abs(alarm_rate-ca)<=0.25*ca and round(cr-recall,4)>=0.05
 order by round(cr-recall,4) desc, scenario limit 1"""
    return {
        "psi_numeric": f"{w} select feature, round(psi,4) as psi, len(e)<3 as degenerate_reference from ps join ed using (feature) where feature<>'probability'",
        "psi_categorical": f"""with {BASE}, {PAIR}, {CATEGORY} select 'type' as feature, cast(nr as bigint) as ref_rows,
 cast(nc as bigint) as cur_rows, round(psi,4) as psi from cp""",
        "ks_two_sample": f"{w} select feature, round(d,6) as statistic, round(p,6) as p_value from kp",
        "chi2_homogeneity": f"""with {BASE}, {EVEN}, {CATEGORY} select 'type' as feature, round(x,4) as statistic,
 cast(dof as int) as dof, round(exp(-x/2),6) as p_value from ch""",
        "drift_table": f"{full} select * from dt",
        "operating_metrics": f"{full} select * from om",
        "drift_verdict": overall,
        "stream_drift": f"{overall}, cast(0 as int) as batch",
        "drift_confirmed": f"{full} select feature, psi, verdict, p_value from dt where significant and psi>=0.1",
        "operating_bands": f"""with {LOG}, t as (select round(avg(case when alarm then 1e0 else 0e0 end),6) as alarm_rate,
 round(quantile_cont(latency_ms,0.5),3) as median_latency_ms,
 round(avg(case when failed then 1e0 else 0e0 end),6) as error_rate from lo) select *,
 case when alarm_rate>0.25 or alarm_rate<0.01 then 'act' when alarm_rate<0.03 or alarm_rate>0.1 then 'watch' else 'stable' end as alarm_band,
 case when median_latency_ms>200 then 'act' when median_latency_ms>=50 then 'watch' else 'stable' end as latency_band,
 case when error_rate>0.05 then 'act' when error_rate>=0.01 then 'watch' else 'stable' end as error_band from t""",
        "stream_deduplicated": f"""with {LOG} select cast(cast(ts as date) as varchar) as day, count(*) as records,
 round(sum(probability),4) as probability_sum from lo group by all""",
        "permutation_importance": f"with {BASE}, {_importance_sql()} select * from im",
        "retrain_contributing": _contributing_sql(),
        "stream_drift_runs": f"""with {_runs_sql()} select cast(run as varchar) as run, feature, psi, verdict, persistent_verdict
 from pd where run < (select cast(max(ts) - interval 1 hour as date) from lo)""",
        "drift_persistent": f"with {_runs_sql()} select * replace (cast(run as varchar) as run) from pd",
        "retrain_trigger": f"""with {_runs_sql()}, pa as (select run, bool_or(persistent_verdict='act') as persistent_act from pd group by run),
 n as (select cast(ts as date) as run, count(failed) as n from lo where cast(ts as date)>date '2024-01-10' group by 1),
 c as (select run, cast(sum(n) over (order by run) as bigint) as new_rows,
 cast(date_diff('day', date '2024-01-10', run) as int) as days_since from n)
 select cast(run as varchar) as run, new_rows, days_since, persistent_act,
 case when persistent_act then 'drift' when new_rows>={C.RETRAIN_ROWS} then 'volume'
 when days_since>={C.RETRAIN_DAYS} then 'schedule' else 'none' end as trigger,
 persistent_act or new_rows>={C.RETRAIN_ROWS} or days_since>={C.RETRAIN_DAYS} as retrain from c join pa using (run)""",
        "scenario_table": f"{sc} select * from st",
        "scenario_silent": f"{sc}{silent}",
        "scenario_silent_found": f"with {BASE}, {EVEN}, {_scenario_ctes(uneven)}{silent}",
        "scenario_harmless": f"""{sc} select scenario, max_psi, max_psi_feature, recall, cost_eur from st, ctl
 where scenario<>'control' and verdict='act' and recall>=cr-0.01 and abs(cost_eur-cc)<1""",
        "scenario_selfcheck": f"""{sc} select bool_and(verdict='stable') filter (where scenario='control') as control_stable,
 bool_and(verdict<>'stable') filter (where scenario<>'control') as all_noticed,
 coalesce(string_agg(scenario,',' order by scenario) filter (where scenario<>'control' and verdict='stable'),'') as unnoticed,
 bool_and(verdict='stable') filter (where scenario='control') and
 bool_and(verdict<>'stable') filter (where scenario<>'control') as passed from st""",
    }


# ---- prediction log, streaming --------------------------------------------------------------

# CTE rc: log records of the scored states.
RECORDS = """rc as (select *, timestamp '2024-01-01' + to_seconds(l_partkey%30*86400+l_linenumber*60) as ts,
 round(('0x'||substr(state_id,1,4))::bigint/1e3,3) as latency_ms, probability>=0.06 as alarm from ss)"""


def log_sql() -> dict[str, str]:
    r = f"with {BASE}, {RECORDS}"
    lo = f"with {LOG}"
    inputs = ", ".join(
        c if c == "type" else f"cast({c} as double) as {c}" for c in C.INPUT_FIELDS
    )
    stats = """count(*) as requests, round(avg(case when alarm then 1e0 else 0e0 end),6) as alarm_rate,
 round(avg(probability),6) as mean_probability, round(avg(latency_ms),6) as mean_latency_ms"""
    n_warnings = "+".join(
        f"case when {c}{op}{C.CONTRACT['columns'][c][k]} then 1 else 0 end"
        for c in C.MEASURES for op, k in (("<", "warn_min"), (">", "warn_max"))
    )
    store = f"""count(*) as rows, cast(sum(case when alarm then 1 else 0 end) as bigint) as alarms,
 round(sum(probability),4) as probability_sum, cast(sum({n_warnings}) as bigint) as warnings from rc"""
    scored_dirty = f"""{DIRTY}, df0 as (select *, round(process_temperature_k-air_temperature_k,1) as temp_difference_k,
 torque_nm*rotational_speed_rpm*2*pi()/60 as power_w, tool_wear_min*torque_nm as wear_torque_min_nm,
 {_reasons()} as reject_reasons from dirty),
 df1 as (select state_id, reject_reasons, reject_reasons='' as accepted,
 case when reject_reasons='' then {score_sql()} end as probability from df0)"""
    return {
        "log_records": f"""{r} select strftime(ts,'%Y-%m-%d %H:%M:%S') as ts, state_id as request_id, cast(0 as int) as row_no,
 probability, alarm, 0.06::double as threshold, '{C.MODEL_NAME}' as model_name, '1' as model_version, latency_ms,
 {_warnings()} as warnings, torque_nm, type from rc""",
        "log_append": f"{r} select 'json' as store, {store} union all select 'table', {store}",
        "log_to_features": f"{r} select {inputs}, probability from rc",
        "log_latest": f"{lo} select id, strftime(ts,'%Y-%m-%d %H:%M:%S') as ts, request_id, row_no, probability from lo order by lo.ts desc, id desc limit 10",
        "log_daily_stats": f"{lo} select cast(cast(ts as date) as varchar) as day, {stats} from lo group by 1",
        "log_counters": f"""{lo}, q as (select *, case when k<10 then 1 else 0 end+case when latency_ms>250 then 1 else 0 end as w from lo)
 select count(distinct request_id) as requests, count(distinct case when failed then request_id end) as requests_failed,
 count(*) as predictions, count(*) filter (where alarm) as alarms, cast(sum(w) as bigint) as warnings,
 count(inputs) as logged, count(*)-count(inputs) as log_failures, round(sum(latency_ms)/1000,3) as latency_seconds from q""",
        "explode_batches": f"""{lo} select request_id, cast(row_no//{C.MAX_BATCH_ITEMS} as int) as batch_no, row_no, probability, alarm,
 round(round(sum(latency_ms) over (partition by request_id, row_no//{C.MAX_BATCH_ITEMS}),3)
  /count(*) over (partition by request_id, row_no//{C.MAX_BATCH_ITEMS}),6) as latency_ms from lo""",
        "batch_predictions": f"""with {BASE} select 'part-'||l_partkey as request_id,
 row_number() over (partition by l_partkey order by state_id)-1 as row_no, probability, probability>=0.06 as alarm,
 0.06::double as threshold, '{C.MODEL_NAME}' as model from ss""",
        "batch_summary": f"""with {BASE} select 'part-'||l_partkey as request_id, count(*) as rows,
 count(*) filter (where probability>=0.06) as alarms, max(probability) as max_probability from ss group by 1""",
        "stream_scored": f"""with {BASE}, {scored_dirty} select state_id, accepted, reject_reasons, probability,
 case when accepted then probability>={C.THRESHOLD} end as alarm from df1""",
        "stream_daily_stats": f"{lo} select cast(cast(ts as date) as varchar) as day, {stats} from lo group by 1",
    }


# ---- gate, ledger, final evaluation ---------------------------------------------------------

VARIANTS = {
    "heat": ("heat",),
    "overload_power": ("overload", "power"),
    "full": ("heat", "overload", "power"),
    "heat_power": ("heat", "power"),
    "heat_overload": ("heat", "overload"),
}


def _violations(min_recall: float, cost: str) -> str:
    return f"""concat_ws(',', case when pr_auc<0.75 then 'pr_auc<0.75' end,
 case when recall<{min_recall} then 'recall<'||format('{{:.2f}}', {min_recall}) end,
 case when cost_eur>{cost} then 'cost_eur>'||format('{{:.2f}}', cast({cost} as double)) end)"""


def bootstrap_ctes(source: str, draws: int, digits: int = 2) -> str:
    """CTEs ending in bi: interval ends from plain resampling, row by row with replacement."""
    return f"""bn as materialized (select row_number() over (order by state_id)-1 as i, count(*) over () as n, probability, machine_failure as y from {source}),
bp as (select d, hash(d, k, {C.SEED}) % n as i from range({draws}) a(d), (select i as k, n from bn)),
bh as (select d, probability, count(*) as n, sum(y) as pos from bp join bn using (i) group by all),
br as (select *, sum(n) over q as cn, sum(pos) over q as cp from bh window q as (partition by d order by probability desc rows unbounded preceding)),
ba as (select d, sum(pos*(cp*1e0/cn))/nullif(sum(pos),0) as ap, sum(pos) filter (where probability>={C.THRESHOLD})/nullif(sum(pos),0) as rec from br group by d),
bi as (select count(ap) as draws, round(quantile_cont(ap,0.025),{digits}) as pr_auc_low, round(quantile_cont(ap,0.975),{digits}) as pr_auc_high,
 round(quantile_cont(rec,0.025),{digits}) as recall_low, round(quantile_cont(rec,0.975),{digits}) as recall_high from ba)"""


def promotion_sql(draws: int = C.BOOTSTRAP_DRAWS) -> dict[str, str]:
    s = f"with {BASE}, {SPLIT}"
    runs = union([
        f"select {i} as run_no, '{n}' as run_name, machine_failure, {score_sql(parts=p)} as probability from sp where split='val'"
        for i, (n, p) in enumerate(VARIANTS.items(), 1)
    ])
    limit = "rows*(1000000/1500e0)"
    ledger = f"""{s}, vr as ({runs}), {metrics_cte("vr", "m", "run_no, run_name")},
 lg as (select run_no, run_name, 'scorer='||run_name as params, rows, pr_auc, roc_auc, recall, "precision", cost_eur,
 {_violations(0.5, limit)}='' as passed, {_violations(0.5, limit)} as violations, '1' as code_version, 'finished' as status from m),
 ve as (select row_number() over (order by run_no) as version, run_no, run_name, pr_auc, recall, cost_eur from lg where passed)"""
    pivots = ", ".join(f"max(value) filter (where run_name='{n}') as {n}" for n in VARIANTS)
    long = union([
        f"select run_name, '{m}' as metric, cast({m} as double) as value from lg"
        for m in ("pr_auc", "roc_auc", "recall", "precision", "cost_eur")
    ])
    final_limit = "rows*(200000/1500e0)"
    gaps = ", ".join(f"round(t.{m}-v.{m},6) as {m}_gap" for m in ("pr_auc", "roc_auc", "recall", "precision"))
    return {
        "quality_gate": f"""{s}, va as (select * from sp where split='val'), {metrics_cte("va", "m")}
 select pr_auc, recall, cost_eur, {_violations(0.8, "200000")} as violations, {_violations(0.8, "200000")}='' as passed from m""",
        "run_ledger": f"{ledger} select * from lg",
        "run_compare": f"{ledger} select metric, {pivots} from ({long}) group by metric",
        "gated_promotion": f"{ledger} select * from ve",
        "champion": f"{ledger} select * from ve order by version desc limit 1",
        "champion_rollback": f"{ledger} select * from ve order by version desc limit 1 offset 1",
        "bootstrap_ci": f"{s}, te as (select * from sp where split='test'), {bootstrap_ctes('te', draws)} select * from bi",
        "final_evaluation": f"""{s}, te as (select * from sp where split='test'), {bootstrap_ctes('te', draws)},
 {metrics_cte("sp", "m", "split")}, t as (select * from m where split='test'), v as (select * from m where split='val'),
 g as (select *, {_violations(0.8, final_limit)} as violations from t)
 select t.rows, t.failures, t.pr_auc, pr_auc_low, pr_auc_high, t.roc_auc, t.recall, recall_low, recall_high,
 t.precision, t.tp, t.fp, t.fn, t.tn, t.cost_eur, t.do_nothing_eur, t.saving_eur, {gaps}, g.violations='' as passed, g.violations
 from t, v, g, bi""",
    }


def all_sql() -> dict[str, str]:
    return {
        **metric_sql(), **table_sql(), **slice_sql(), **drift_sql(), **log_sql(), **promotion_sql(),
    }
