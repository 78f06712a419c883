"""The same queries in SQL over the flat test tables (DuckDB dialect)."""

from __future__ import annotations

_AGE_DAYS = "((c_custkey * 7919) % 29220)"

_TABLES = f"""
patient as materialized (
  select cast(c_custkey as varchar) patient_id, c_name family, n_name city,
    'official|Dr. ' || c_name || '|' || c_name || '|G' || (c_custkey % 10) || '|Dr.||2001-01-01' name_text,
    'home|' || (c_custkey % 97) || ' Main St|' || n_name || '|S' || n_nationkey || '|'
      || lpad(cast(c_custkey % 100000 as varchar), 5, '0') || '|' || r_name || '|2001-01-01' address_text,
    case when c_custkey % 10 <> 0 then 'urn:marital|' || case c_custkey % 3 when 0 then 'M|Married'
      when 1 then 'S|Single' else 'D|Divorced' end || '|' || case when c_custkey % 2 = 0 then 'true' else 'false' end
      end marital_text,
    strftime(date '1930-01-01' + cast({_AGE_DAYS} as integer), '%Y-%m-%d') "birthDate",
    case when c_custkey % 2 = 0 then 'female' else 'male' end gender,
    case when c_custkey % 10 = 0 then null
      else case c_custkey % 3 when 0 then 'M' when 1 then 'S' else 'D' end end marital_status
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
cond_all as materialized (
  select 'c' || l_orderkey || '-' || l_linenumber id,
    case when l_partkey % 53 <> 0 then case when p_size * 8 <= 80 - ((o_custkey * 7919) % 29220) / 365.25::double
      then '' else 'x' end || o_custkey end patient_id,
    case when p_partkey % 89 = 0 or p_partkey % 97 = 0 then null else p_brand end code,
    case when p_partkey % 89 = 0 or p_partkey % 97 = 0 then null else p_type end display,
    case when p_partkey % 89 = 0 then null when p_partkey % 97 = 0 then 0 else 1 end codings
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
  where l_returnflag = 'R'),
cond as materialized (select * from cond_all where patient_id is not null),
med as materialized (
  select 'm' || l_orderkey || '-' || l_linenumber id,
    case when l_linestatus = 'O' and l_shipdate >= timestamp '2001-01-01' then '' else 'x' end || o_custkey patient_id,
    cast(p_partkey as varchar) code, p_name display, l_returnflag status, 'order' intent,
    strftime(l_shipdate, '%Y-%m-%d') authored, 'e' || l_orderkey encounter_id
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
  where l_returnflag is distinct from 'R'),
enc as materialized (
  select 'e' || o_orderkey id, case when o_custkey % 7 = 0 then 'x' else '' end || o_custkey patient_id,
    o_orderstatus status,
    left(o_orderpriority, 1) type_code, substring(o_orderpriority, 3) type_name,
    strftime(o_orderdate, '%Y-%m-%d') start_date,
    case when o_orderstatus = 'P' then null
      else strftime(cast(o_orderdate as date) + 1, '%Y-%m-%d') end end_date,
    o_orderpriority class_code, 'o' || (o_custkey % 25) organization_id
  from orders),
cond_agg as materialized (
  select patient_id,
    array_to_string(list_sort(list(distinct coalesce(code, '') || '|' || coalesce(display, ''))), ';') conditions,
    count(distinct coalesce(code, '') || '|' || coalesce(display, '')) listed,
    count(distinct code) condition_count, count(*) condition_row_count
  from cond group by patient_id),
med_agg as materialized (
  select patient_id,
    array_to_string(list_sort(list(id || '|' || code || '|' || display || '|' || status || '|' || intent
      || '|' || authored || '|' || encounter_id)), ';') medications, count(*) medication_count
  from med group by patient_id),
enc_agg as materialized (
  select patient_id,
    array_to_string(list_sort(list(id || '|' || status || '|' || type_code || '|' || type_name || '|' || start_date
      || '|' || coalesce(end_date, '') || '|' || class_code || '|' || organization_id)), ';') encounters,
    count(*) encounter_count
  from enc group by patient_id),
master as materialized (
  select p.*, conditions, listed, condition_count, medications, medication_count, encounters, encounter_count
  from patient p left join cond_agg using (patient_id) left join med_agg using (patient_id)
    left join enc_agg using (patient_id)),
ages as materialized (
  select m.*, cast(2023 - year(cast("birthDate" as date))
      - case when '02-28' < substring("birthDate", 6) then 1 else 0 end as integer) age,
    case when d.patient_id is not null then 1 else 0 end disease
  from master m left join (select distinct patient_id from cond where display = 'PROMO') d using (patient_id))
"""


def _with(body: str, *extra: str) -> str:
    return "with " + ", ".join([_TABLES, *extra]) + " " + body


_MASTER = _with("""
select patient_id, 0 page, "birthDate", gender, name_text, address_text, marital_text, conditions, condition_count::double condition_count,
  medication_count::double medications_listed, medication_count::double medication_count,
  encounter_count::double encounters_listed, encounter_count::double encounter_count, 1 list_pages
from master""")

_COND_ITEMS = """select distinct c.patient_id, c.code condition_code, c.display condition_name, a.condition_count{more}
  from cond c join cond_agg a using (patient_id)"""

_ITEMS = _with("""
select m.patient_id, m.condition_count::double condition_count, m.medication_count::double medication_count,
  m.encounter_count::double encounter_count, i.list, i.a, i.b
from master m join (
  select distinct patient_id, 'conditions' list, code a, display b from cond
  union all select patient_id, 'medications', id, code from med
  union all select patient_id, 'encounters', id, status from enc) i using (patient_id)""")

_WIDE = {f"extra_{i}": f"cast(patient_id as integer) % {i + 2} <> 0" for i in range(8)}

# --- regressions: the tail probability is the finite series for whole df ------

_PAIRS = """pairs as (
  select 'medication_count' measure, gender, age::double x, medication_count::double y from ages
  union all select 'disease', gender, age::double, disease::double from ages
  union all select 'condition_count', gender, age::double, condition_count::double from ages
  union all select 'condition_count_zero', gender, age::double, coalesce(condition_count, 0)::double from ages)"""

_P = """1 - case when df % 2 = 1 then 2 / pi() * (th + sin(th) * coalesce(list_sum(list_transform(
    range(0, (df - 1) // 2), lambda k: exp(lgamma(k + 1) + lgamma(1.5) - lgamma(k + 1.5))
      * pow(cos(th), 2 * k + 1))), 0))
  else sin(th) * coalesce(list_sum(list_transform(
    range(0, df // 2), lambda k: exp(lgamma(k + 0.5) - lgamma(0.5) - lgamma(k + 1)) * pow(cos(th), 2 * k))), 0) end"""


def _fits(by: str = "") -> tuple[str, ...]:
    g = f"{by}, " if by else ""
    return (
        _PAIRS,
        f"""moments as (
          select {g}measure, count(*) n, regr_slope(y, x) slope, regr_intercept(y, x) intercept,
            regr_r2(y, x) r2, regr_sxx(y, x) sxx, regr_syy(y, x) syy, regr_sxy(y, x) sxy, count(*) - 2 df
          from pairs where x is not null and y is not null group by {g}measure)""",
        """tested as (
          select *, sign(sxy) * sqrt(r2) r, sqrt((1 - r2) * syy / sxx / df) stderr,
            sign(sxy) * sqrt(r2) * sqrt(df / (1 - r2)) t,
            atan(sqrt(r2 / (1 - r2))) th from moments)""",
        f"fits as (select *, greatest(0.0::double, {_P}) p from tested)",
    )


_SPAN = "span as (select min(age)::double lo, max(age)::double hi from ages)"
_THREE = "measure in ('medication_count', 'disease', 'condition_count')"


def _regression(measure: str) -> str:
    return _with(
        f"""select n, round(slope, 6) slope, round(intercept, 6) intercept, round(r, 6) r, round(r2, 6) r2,
          round(stderr, 6) stderr, round(t, 6) t, round(p, 6) p, p < 0.05 significant
        from fits where measure = '{measure}'""",
        *_fits(),
    )


_SUMMARY_OF_FITS = _with(
    f"select measure, round(r2, 6) r2, round(p, 6) p, p < 0.05 significant from fits where {_THREE}", *_fits()
)

_PREDICTED = """points as (
  select a.age, measure, slope * a.age + intercept y
  from fits, (select unnest([0, 18, 30, 50, 65, 100])::double age) a)"""

# --- null profiles ------------------------------------------------------------


def _profile(table: str, columns: dict[str, str], total_columns: int | None = None) -> str:
    head = "" if total_columns is None else f"'{table}' as \"table\", {total_columns} total_columns, "
    source = {"condition": "cond_all", "medicationrequest": "med", "encounter": "enc", "observation": "events"}
    parts = [
        f"""select {head}'{name}' as "column", count(*) total_rows, count(*) filter ({test}) null_count,
          round(coalesce(count(*) filter ({test}) * 100.0::double / nullif(count(*), 0), 0), 2) null_pct
        from {source.get(table, table)} having count(*) filter ({test}) > 0"""
        for name, test in columns.items()
    ]
    return " union all ".join(parts)


_RAW = " union all ".join(
    [
        _profile("patient", {"maritalStatus": "marital_status is null"}, 6),
        _profile("condition", {"subject": "patient_id is null"}, 3),
    ]
)

_SUMMARY = """
select 'patient' resource, count(*) "rows", 6 columns, 0::bigint corrupt_rows from patient
union all select 'condition', count(*), 3, 0 from cond_all
union all select 'encounter', count(*), 7, 0 from enc
union all select 'observation', count(*), 5, 0 from events
union all select 'medicationrequest', count(*), 7, 0 from med"""

_COUNTS = _with(
    """select patient_id, "birthDate", gender, condition_count::double condition_count,
      medication_count::double medication_count, encounter_count::double encounter_count from master"""
)

_FANOUT = """fan as (
  select patient_id, c.n condition_rows, m.n medicationrequest_rows, e.n encounter_rows,
    c.n::hugeint * m.n * e.n naive_rows
  from patient join (select patient_id, count(*) n from cond group by 1) c using (patient_id)
    join (select patient_id, count(*) n from med group by 1) m using (patient_id)
    join (select patient_id, count(*) n from enc group by 1) e using (patient_id))"""


def _types(which: str, absent: str = "count_if(not bare)", no_subject: str = "VOID") -> str:
    """Counts of types by path over the conditions that `which` picks. Archives
    are written without NULL fields, which `no_subject` tells."""
    rows = [
        ("id", "STRING", "count(*)", "'string'", False),
        ("subject", "OBJECT", "count(patient_id)", "'struct'", False),
        ("subject", no_subject, "count_if(patient_id is null)", "'struct'", False),
        ("subject.reference", "STRING", "count(patient_id)", "'string'", False),
        ("code", "OBJECT", "count_if(not bare)", "'struct'", False),
        ("code", "STRING", "count_if(bare)", "'struct'", True),
        ("code.coding", "ARRAY", "count_if(not bare)", "'array'", False),
        ("code.coding[]", "OBJECT", "sum(codings)", "'struct'", False),
        ("code.coding[].code", "STRING", "sum(codings)", "'string'", False),
        ("code.coding[].display", "STRING", "sum(codings)", "'string'", False),
        ("weight", "BIGINT", "count_if(bare)", "null", True),
        ("weight", "ABSENT", absent, "null", False),
    ]
    parts = " union all ".join(
        f"select '{path}' path, '{kind}' type, cast({n} as bigint) n, {pinned}::varchar pinned, {lost} lost from chosen"
        for path, kind, n, pinned, lost in rows
    )
    chosen = f"chosen as (select * from (select *, codings is null bare from cond_all) where {which})"
    return _with(f"select * from ({parts}) where n > 0", chosen)


ORACLE: dict[str, str] = {
    "patient_base": _with('select patient_id, "birthDate", gender, marital_status, city from patient'),
    "ref_ids": _with("""
        select id, patient_id, null::varchar encounter_id from cond_all
        union all select id, patient_id, encounter_id from med
        union all select id, patient_id, id from enc"""),
    "encounter_flat": _with("""
        select id encounter_id, type_code encounter_type_code, type_name encounter_type_name,
          start_date, end_date, class_code, organization_id from enc"""),
    "coding_paths": _with("select id, code, display, codings::double codings from cond_all"),
    "conditions_per_patient": _with("select patient_id, 0 page, conditions, condition_count from cond_agg"),
    "rows_used": """select 'lineitem' "table", count(*) n from lineitem union all select 'orders', count(*) from orders""",
    "conditions_paged": _with(_COND_ITEMS.format(more=", a.condition_row_count row_count")),
    "medications_paged": _with("""
        select patient_id, id medication_id, code medication_code, display medication_name, status medication_status,
          intent, authored "authoredOn", encounter_id, medication_count from med join med_agg using (patient_id)"""),
    "patient_master_paged": _ITEMS,
    "jsonl_paged": _ITEMS,
    "patient_master_whole": _with("select patient_id, cast(coalesce(medication_count, 0) as integer) listed from master"),
    "conditions_row_count": _with(
        "select patient_id, 0 page, condition_row_count, cast(listed as integer) listed from cond_agg"
    ),
    "medications_per_patient": _with("select patient_id, 0 page, medications, medication_count from med_agg"),
    "encounters_per_patient": _with("select patient_id, 0 page, encounters, encounter_count from enc_agg"),
    "sample_row": _with(
        "select * from (" + _COND_ITEMS.format(more="") + ") where patient_id = (select min(patient_id) from cond)"
    ),
    "patient_master": _MASTER,
    "patient_master_broadcast": _MASTER,
    "patient_counts": _COUNTS,
    "master_invariants": _with("""
        select count(*) patients, count(*) master_rows, 0::bigint doubled_pages, 0::bigint missing_pages, 0::bigint duplicate_keys,
          (select count(*) from med where patient_id in (select patient_id from patient)) medications_listed,
          (select count(*) from med where patient_id in (select patient_id from patient)) medications_rows,
          (select count(*) from enc where patient_id in (select patient_id from patient)) encounters_listed,
          (select count(*) from enc where patient_id in (select patient_id from patient)) encounters_rows
        from patient"""),
    "join_fanout": _with(
        "select patient_id, condition_rows, medicationrequest_rows, encounter_rows, naive_rows::varchar naive_rows from fan",
        _FANOUT,
    ),
    "join_fanout_total": _with(
        "select cast(sum(naive_rows)::hugeint as varchar) naive_rows, count(*) patients from fan", _FANOUT
    ),
    "key_lookup": _with("""
        select k.patient_id, 0 page,
          coalesce(array_to_string(list_sort(list(coalesce(display, '')) filter (c.patient_id is not null)), ';'), '') "names",
          cast(count(c.patient_id) as integer) listed
        from (select cast(c_custkey as varchar) patient_id from customer
              union all select 's' || s_suppkey from supplier) k
          left join cond c on k.patient_id = c.patient_id
        group by k.patient_id"""),
    "null_profile": _with(_profile("patient", {"marital_status": "marital_status is null"})),
    "null_profile_first": """select 'a' "column", count(*) total_rows, count(*) null_count, 100.0::double null_pct
        from lineitem""",
    "ndjson_widened": _with(_profile("patient", {"maritalStatus": "marital_status is null", **_WIDE}, 14)),
    "ndjson_widened_summary": _with("select 'patient' resource, count(*) \"rows\", 14 columns, 0::bigint corrupt_rows from patient"),
    "resource_views": _with("select status, count(*) n, min(start_date) first_start from enc group by status"),
    "raw_quality": _with(_RAW),
    "load_summary": _with(_SUMMARY),
    "master_quality": _with("""
        select count(*) total_patients, count(condition_count) with_conditions,
          count(medication_count) with_medications, count(encounter_count) with_encounters,
          round(count(condition_count) * 100.0::double / count(*), 1) conditions_pct,
          round(count(medication_count) * 100.0::double / count(*), 1) medications_pct,
          round(count(encounter_count) * 100.0::double / count(*), 1) encounters_pct,
          round(coalesce(avg(condition_count), 0), 2) avg_conditions,
          round(coalesce(avg(medication_count), 0), 2) avg_medications,
          round(coalesce(avg(encounter_count), 0), 2) avg_encounters
        from master"""),
    "patient_age": _with("select patient_id, age from ages"),
    "disease_flag": _with("select patient_id, disease flag from ages"),
    "disease_flag_from_lists": _with("select patient_id, disease flag from ages"),
    "disease_hits": _with("""
        select distinct patient_id, display disease from cond
        where patient_id in (select patient_id from patient)
          and display in (select p_type from part where p_type > 'M')"""),
    "pages_have_no_gaps": """
        select cast(o_custkey as varchar) k, true gapless, true complete, count(*) listed, count(*) n
        from orders group by o_custkey""",
    "disease_flags": _with("""
        select p.patient_id, d.disease, case when c.patient_id is not null then 1 else 0 end flag
        from patient p cross join (select unnest(['PROMO', 'STANDARD', 'ECONOMY', 'NOT A DISEASE']) disease) d
          left join (select distinct patient_id, display from cond) c
            on c.patient_id = p.patient_id and c.display = d.disease"""),
    "regress_medications": _regression("medication_count"),
    "regress_disease": _regression("disease"),
    "regress_conditions": _regression("condition_count"),
    "regress_conditions_zero": _regression("condition_count_zero"),
    "regression_summary": _SUMMARY_OF_FITS,
    "regression_by_group": _with(
        f"select gender, measure, n, round(slope, 6) slope, round(r2, 6) r2, round(p, 6) p from fits where {_THREE}",
        *_fits("gender"),
    ),
    "predict_at_ages": _with(
        """select age, round(max(y) filter (measure = 'medication_count'), 6) medications,
          round(greatest(0, least(1, max(y) filter (measure = 'disease'))), 6) disease_probability,
          round(max(y) filter (measure = 'condition_count'), 6) conditions,
          round(greatest(0, least(1, max(y) filter (measure = 'disease'))) * 100, 6) disease_percent
        from points group by age""",
        *_fits(),
        _PREDICTED,
    ),
    "predict_patients": _with(
        """select patient_id, a.age, measure, round(greatest(0, least(1, slope * a.age + intercept)), 6) predicted
        from ages a, fits where measure = 'disease'""",
        *_fits(),
    ),
    "regression_line": _with(
        f"""select measure, cast(i as integer) i, round(lo + i * (hi - lo) / 99, 6) x,
          round(slope * (lo + i * (hi - lo) / 99) + intercept, 6) y
        from fits, span, (select unnest(range(0, 100)) i) where {_THREE}""",
        *_fits(),
        _SPAN,
    ),
    "scatter_counts": _with(
        f"""select measure, cast(x as integer) x, y, count(*) n from pairs
        where {_THREE} and x is not null and y is not null group by measure, x, y""",
        _PAIRS,
    ),
    "jsonl_roundtrip": _MASTER,
    "regression_from_jsonl": _SUMMARY_OF_FITS,
    "ndjson_scan": _with(_SUMMARY),
    "ndjson_master": _COUNTS,
    "ndjson_inferred": """
        select 'ob' || event_id id, cast(user_id as varchar) patient_id, event_type code, round(value, 6) as value
        from events""",
    "export_log": """
        select 'export-' || user_id "exportId",
          case event_id % 3 when 0 then 'kickoff' when 1 then 'manifest_complete' else 'export_complete' end "eventId",
          cast(epoch(date_trunc('second', ts)) as bigint) + 4 * 3600 at_seconds,
          case when event_id % 3 = 0 then 'https://example.com/' || event_type end "exportUrl",
          case when event_id % 3 = 1 then event_id::double end "totalOutputFileCount",
          case when event_id % 3 = 2 then user_id::double end files,
          null::varchar attachments,
          case when event_id % 3 = 2 then (event_id % 1000)::double end duration
        from events""",
    "archive_inventory": """
        select 'export/Nation' || n_nationkey || '.00000.ndjson' entry, cast(coalesce(sum(octet_length(encode(
          '{"id":"' || c_custkey || '","name":"' || c_name || '"}')) + 1), 0) as bigint) bytes, false stored
        from nation left join customer on c_nationkey = n_nationkey group by n_nationkey""",
    "archive_ingest_ranges": _with("select id, patient_id, code, display from cond_all"),
    "archive_ingest_streams": _with("select id, patient_id, code, display from cond_all"),
    "archive_ingest": _with("select id, patient_id, code, display from cond_all"),
    "landed_again": _with("select id, patient_id, code, display from cond_all"),
    "landed_archives": _with("select id, patient_id, code, display from cond_all"),
    "landed_again_summary": _with(
        "select 'condition' resource, count(*) as rows, 3 as columns, 0::bigint corrupt_rows from cond_all"
    ),
    "clustered_master": _MASTER,
    "clustered_master_paged": _ITEMS,
    "clustered_counts": _COUNTS,
    "clustered_medications": _with("select patient_id, 0 page, medications, medication_count from med_agg"),
    "clustered_lookup": _with("""
        select w.patient_id, 0 page, coalesce(conditions, '') conditions
        from (select cast(c_custkey as varchar) patient_id from customer
          union all select 's' || s_suppkey from supplier) w left join cond_agg using (patient_id)"""),
    "types_by_path": _types("true"),
    "types_by_path_archives": _types("bare", "null", "ABSENT"),
    "distinct_codes_estimated": _with("""
        select gender, count(distinct c.code) codes, true close from patient join cond c using (patient_id)
        group by gender union all
        select null, count(distinct code), true from cond where patient_id in (select patient_id from patient)"""),
}
