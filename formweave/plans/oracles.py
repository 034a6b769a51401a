r"""Independent SQL (DuckDB dialect) for the registered queries.

Each text re-derives its inputs from the benchmark tables with the same
fixture SQL, then computes the operator its own way: ``UNPIVOT`` and joins
where Spark uses literal maps, window ``row_number`` where Spark
de-duplicates inside arrays, ``last_value(... ignore nulls)`` over whole
forms where Spark fills by buckets.  Queries whose output has no SQL twin
would be listed in ``ROWS_ONLY``.
"""

from __future__ import annotations

from formweave.plans import fixtures as fx
from formweave.plans import spec_exports
from formweave.plans.specs import biorepository_profile, registry_profile

DATE_SQL_FORMATS = ("%Y-%m-%d", "%Y-%m-%d %H:%M", "%Y-%m-%d %H:%M:%S", "%m/%d/%Y", "%m/%d/%Y %H:%M")
SF_DIR = "/root/testdata/sf0.01"


def _date(col: str) -> str:
    return "coalesce(" + ", ".join(f"try_strptime({col}, '{f}')" for f in DATE_SQL_FORMATS) + ")"


def _dd(src: str) -> str:
    return f"""dd_raw as ({src}),
dd as (
  select ord, field, form,
         case when form is null then hdr
              else last_value(hdr ignore nulls) over (partition by form order by ord
                   rows between unbounded preceding and current row) end as hdr,
         ftype, label,
         case when ftype = 'yesno' and (choices is null or upper(choices) = 'NAN')
              then '0, No | 1, Yes' else choices end as choices,
         vtype, vmin, vmax, logic, required
  from dd_raw where ftype is null or ftype <> 'descriptive')"""


CHOICE = r"""
ch_split as (
  select field, string_split(choices, '|') as arr from dd
  where coalesce(ftype <> 'calc', true) and choices is not null),
ch_items as (select field, arr, unnest(range(0, len(arr))) as pos from ch_split),
ch_parsed as (
  select field, pos, arr[pos + 1] as item,
         regexp_extract(arr[pos + 1], '^\s*([-0-9]+)\s*,', 1) as code,
         regexp_extract(arr[pos + 1], '(?s)^\s*[-0-9]+\s*,\s*(.*?)\s*$', 1) as label,
         regexp_matches(arr[pos + 1], '(?s)^\s*[-0-9]+\s*,\s*\S') as valid,
         trim(arr[pos + 1]) = '' as blank
  from ch_items),
choice as (
  select field, code, label from (
    select field, code, label,
           row_number() over (partition by field, code order by pos desc) as rn
    from ch_parsed where valid) where rn = 1)"""


def _code(col: str) -> str:
    return f"cast(cast(trunc({col}) as bigint) as varchar)"


def _recoded(cols: list[str], src: str) -> tuple[str, str, str]:
    """(guard CTE, select list, joins) recoding ``cols`` of ``src`` (codes already text)."""
    guard = "guard as (select " + ", ".join(
        f"coalesce(bool_and({c} is null or {c} in (select code from choice where field = '{c}')), true) as g_{c}"
        for c in cols) + f" from {src})"
    sel = ", ".join(f"case when (select g_{c} from guard) then ch_{c}.label else s.{c} end as {c}" for c in cols)
    joins = " ".join(f"left join choice ch_{c} on ch_{c}.field = '{c}' and ch_{c}.code = s.{c}" for c in cols)
    return guard, sel, joins


def _with(*parts: str) -> str:
    return "with " + ",\n".join(p.strip() for p in parts) + "\n"


CUSTOMER = [f"dump as ({fx.CUSTOMER_DUMP_SQL})", _dd(fx.CUSTOMER_DICT_SQL), CHOICE]
ORDERS = [f"dump as ({fx.ORDERS_DUMP_SQL})", _dd(fx.ORDERS_DICT_SQL), CHOICE]
PART = [_dd(fx.PART_DICT_SQL), CHOICE]

_cust_guard, _cust_sel, _cust_join = _recoded(["gender", "site", "ibd"], "codes")
RECODE = _with(*CUSTOMER, f"""codes as (select subid, redcap_event_name, {_code('gender')} as gender,
   {_code('site')} as site, {_code('ibd')} as ibd from dump)""", _cust_guard) + f"""
select s.subid, s.redcap_event_name, {_cust_sel} from codes s {_cust_join}"""

CHECKBOX_TABLE = _with(*CUSTOMER, """boxes as (
  unpivot (select subid, redcap_event_name, race___1, race___2, race____1 from dump)
  on race___1, race___2, race____1 into name box value checked)""", """ticked as (
  select subid, redcap_event_name, replace(split_part(box, '___', 2), '_', '-') as code
  from boxes where checked = 1)""") + """
select t.subid, t.redcap_event_name, c.label as race
from ticked t left join choice c on c.field = 'race' and c.code = t.code
union
select subid, redcap_event_name, lower(race_oth) as race from dump where race_oth is not null"""

REQUIRED_CHECK = _with(*CUSTOMER, """cv as (
  select cast(subid as varchar) as subid, cast(gender as varchar) as gender,
         cast(site as varchar) as site, cast(ibd as varchar) as ibd, age, balance, race_oth from dump)""",
                        """cells as (
  select * from cv unpivot include nulls (v for field in (subid, gender, site, ibd, age, balance, race_oth)))""") + """
select c.field, 'required' as rule, count(*) filter (where c.v is null) as n_bad
from cells c join dd on dd.field = c.field and dd.required = 'y'
group by c.field"""

_CHOICE_BAD = "{c} is not null and " + _code("{c}") + " not in (select code from choice where field = '{c}')"
COLUMN_REPORT = _with(*CUSTOMER) + " union all\n".join([
    "select 'subid' as field, 'required' as rule, count(*) filter (where subid is null) as n_bad from dump",
    f"select 'gender', 'choice', count(*) filter (where {_CHOICE_BAD.format(c='gender')}) from dump",
    "select 'gender', 'required', count(*) filter (where gender is null) from dump",
    f"select 'site', 'choice', count(*) filter (where {_CHOICE_BAD.format(c='site')}) from dump",
    f"select 'ibd', 'choice', count(*) filter (where {_CHOICE_BAD.format(c='ibd')}) from dump",
    "select 'ibd', 'required', count(*) filter (where ibd is null) from dump",
    "select 'age', 'type', count(*) filter (where age is not null and try_cast(age as double) is null) from dump",
    "select 'age', 'range', count(*) filter (where try_cast(age as double) < 0 or try_cast(age as double) > 20) from dump",
    "select 'age', 'required', count(*) filter (where age is null) from dump",
    "select 'balance', 'type', count(*) filter (where balance is not null and try_cast(balance as double) is null) from dump",
    r"select 'balance', 'decimals', count(*) filter (where not coalesce(regexp_matches(balance, '^[+-]?[0-9]+(\.[0-9]{2})?$'), true)) from dump",
    "select 'balance', 'range', count(*) filter (where try_cast(balance as double) < 0 or try_cast(balance as double) > 5000) from dump",
])

MEMBERSHIP = _with(*CUSTOMER) + """
select subid,
       coalesce(redcap_event_name in ('BUILDING', 'MACHINERY'), false) as in_set,
       not coalesce(cast(site as varchar) in ('1.0', '2.0'), false) as site_not_in,
       coalesce(race_oth, '') as other_text,
       coalesce(cast(gender as varchar), '') as gender_text
from dump"""

DROP_NULL_KEY = _with(*CUSTOMER, """d as (
  select case when subid % 8 <> 0 then subid end as subid, redcap_event_name, gender, site, race_oth from dump)""") + """
select * from d
where subid is not null and not (gender is null and site is null and race_oth is null)"""

_ord_guard, _ord_sel, _ord_join = _recoded(["priority", "paid"], "codes")
_ORDERS_CODES = f"""codes as (
  select subid, redcap_event_name, {_code('priority')} as priority, {_code('paid')} as paid,
         total, {_date('visit_date')} as visit_date,
         priority is null and paid is null and total is null and visit_date is null as empty
  from dump)"""
PARENT_TABLE = _with(*ORDERS, _ORDERS_CODES, _ord_guard) + f"""
select distinct s.subid, s.redcap_event_name, {_ord_sel}, cast(s.total as double) as total, s.visit_date
from codes s {_ord_join} where not s.empty"""

SUBJECT_EVENTS = _with(*ORDERS, _ORDERS_CODES, _ord_guard, f"""t as (
  select distinct s.subid, s.redcap_event_name, {_ord_sel}
  from codes s {_ord_join} where not (s.priority is null and s.paid is null))""") + """
select subid, priority, paid from t"""

DATE_RECAST = _with(*ORDERS) + f"""
select subid, redcap_event_name, visit_date as visit_date_raw, {_date('visit_date')} as visit_date from dump"""

LINEITEM_BOUNDS = """
select * from (values
 (0, 'l_quantity', 'text', 'line', null, 'Quantity', null, 'number', '1', '45', null, null),
 (1, 'l_discount', 'text', 'line', null, 'Discount', null, 'number', '0', '0.08', null, null),
 (2, 'l_tax', 'text', 'line', null, 'Tax', null, 'number', null, '0.06', null, null)
) as t(ord, field, ftype, form, hdr, label, choices, vtype, vmin, vmax, logic, required)
"""
RANGE_CHECK = _with(f"b as (select field, try_cast(vmin as double) as lo, try_cast(vmax as double) as hi from ({LINEITEM_BOUNDS}))",
                    """v as (unpivot (select l_quantity, l_discount, l_tax from lineitem)
  on l_quantity, l_discount, l_tax into name field value x)""") + """
select b.field, count(v.x) as n_values,
       count(*) filter (where (b.lo is not null and v.x < b.lo) or (b.hi is not null and v.x > b.hi)) as n_out_of_range
from v join b on b.field = v.field group by b.field"""

PART_PRICE = """
select p_partkey,
       case when p_partkey % 9 = 0 then cast(p_retailprice as string) || '.5'
            when p_partkey % 14 = 0 then 'a' || cast(p_retailprice as string)
            when p_partkey % 10 = 0 then null
            when p_partkey % 4 = 0 then cast(p_retailprice as string) || '5'
            else cast(p_retailprice as string) end as price_text
from part
"""
DECIMALS_CHECK = _with(f"p as ({PART_PRICE})") + r"""
select p_partkey, price_text,
       coalesce(regexp_matches(price_text, '^[+-]?[0-9]+(\.[0-9]{1})?$'), true) as ok_1dp,
       coalesce(regexp_matches(price_text, '^[+-]?[0-9]+(\.[0-9]{2})?$'), true) as ok_2dp
from p"""

SUBJECT_ID = _with(f"ids as ({fx.CUSTOMER_IDS_SQL})",
                   "p as (select *, string_split(biorepidnumber, '.') as parts from ids)") + """
select id_key, biorepidnumber,
       case len(parts) when 1 then biorepidnumber when 2 then parts[1] end as proband_id,
       case when len(parts) = 2 then parts[2] end as relation_code,
       case when len(parts) = 1 then 'proband'
            when len(parts) = 2 then case parts[2] when '0' then 'proband' when '2' then 'mother'
                 when '3' then 'father' when '4' then 'sibling' when '5' then 'sibling'
                 when '6' then 'sibling' when '7' then 'sibling' end end as relation,
       len(parts) <= 2 and not (len(parts) = 2 and parts[2] = '1') as valid
from p"""

BATCH_SUBJECT = _with(f"f as ({fx.CUSTOMER_FILES_SQL})") + r"""
select file_key, file_name,
       case when regexp_matches(file_name, '^.+\.[^.]+$') then regexp_replace(file_name, '\.[^.]+$', '')
            else file_name end as stem,
       regexp_replace(split_part(file_name, '_', 2), 'F*D*M*P*$', '') as subject_id
from f"""

ASSETS = r"""
with b as (select regexp_extract(filename, '[^/]*$') as file_name, filename, size
           from read_blob('""" + SF_DIR + r"""/*.parquet'))
select file_name, 'file:' || regexp_replace(filename, '/[^/]*$', '') as directory,
       'BENCH' as batch_code, 'PARQUET' as file_type, 'TABLES' as assay_type, size as bytes,
       case when regexp_matches(file_name, '^.+\.[^.]+$') then regexp_replace(file_name, '\.[^.]+$', '')
            else file_name end as subject_id
from b"""

ASSET_BATCHES = r"""
with b as (select regexp_extract(filename, '[^/]*$') as file_name, filename, size
           from read_blob('""" + SF_DIR + r"""/*.parquet')),
m as (
  select 'BENCH' as batch_code, 'ORDERS' as file_type, 'WES' as assay_type, b.* from b where file_name = 'orders.parquet'
  union all select 'BENCH', 'ORDERS', 'WES', b.* from b where starts_with(file_name, 'o')
  union all select 'BENCH', 'PARTS', 'WES', b.* from b where starts_with(file_name, 'p')
  union all select 'REGENERON1', 'TABLES', 'WGS', b.* from b where file_name in ('nation.parquet', 'region.parquet')
  union all select 'REGENERON1', 'TABLES', 'WGS', b.* from b where file_name[1] between 'e' and 'l')
select file_name, 'file:' || regexp_replace(filename, '/[^/]*$', '') as directory, batch_code, file_type, assay_type,
       size as bytes,
       -- no table's name has a second token
       case when batch_code = 'BENCH' then regexp_replace(file_name, '\.[^.]+$', '') end as subject_id
from m"""

CONTENT_MD5 = """
select regexp_extract(filename, '[^/]*$') as file_name, size as bytes, md5(content) as md5
from read_blob('""" + SF_DIR + """/*.parquet')"""

CHOICES = _with(*PART) + "select field, code, label from choice"

CHOICES_STRICT = _with(*PART, """st_items as (select field, arr, unnest(range(0, len(arr))) as pos from ch_split)""",
                       """st_parsed as (select field, pos, string_split(trim(arr[pos + 1]), ',') as parts from st_items)""",
                       r"""st as (
  select field, pos,
         len(parts) = 2 and regexp_matches(trim(parts[1]), '^[+-]?[0-9]+$') as ok,
         case when len(parts) = 2 and regexp_matches(trim(parts[1]), '^[+-]?[0-9]+$')
              then cast(trim(parts[1]) as bigint) end as code,
         case when len(parts) = 2 and regexp_matches(trim(parts[1]), '^[+-]?[0-9]+$')
              then trim(parts[2]) end as label
  from st_parsed)""", "good as (select field from st group by field having bool_and(ok))") + """
select field, code, label from (
  select st.field, code, label, row_number() over (partition by st.field, code order by pos desc) as rn
  from st join good on good.field = st.field) where rn = 1"""

MALFORMED_CHOICES = _with(*PART) + "select field, pos, item from ch_parsed where not valid and not blank"

SECTION_HEADER = _with(*PART) + "select field, form, hdr from dd"

BRANCH_EDGES = _with(*PART, r"""lower_raw as (
  select field, unnest(regexp_extract_all(logic, '((?:\[\w+(?:\(\d+\))?\]\s*)+)', 1)) as raw
  from dd where logic is not null and trim(logic) <> '')""") + r"""
select distinct src, dst, label from (
  select 'start' as src, field as dst, '' as label from dd where logic is null or trim(logic) = ''
  union all
  select regexp_replace(regexp_replace(trim(raw), '\]\s*\[', ':', 'g'), '^\[|\]$', '', 'g'), field, ''
  from lower_raw)"""

LOGIC_VALUES = _with(*PART, r"""lv as (
  select field, regexp_extract_all(logic, '(?:<>|>=|<=|>|<|=)\s*(''[^'']*''|"[^"]*"|\w+)', 1) as arr
  from dd where logic is not null and trim(logic) <> '')""",
                     "lv2 as (select field, arr, unnest(range(0, len(arr))) as pos from lv)") + r"""
select field, pos, regexp_replace(arr[pos + 1], '^[''"]|[''"]$', '', 'g') as value from lv2"""

# Quoted text is taken out first (a mark holds its place), then the rest is read.
LOGIC_TOKENS = f"""
with dd as ({fx.PART_LOGIC_SQL}),
quoted as (select field, logic, regexp_extract_all(logic, '''[^'']*''|"[^"]*"') as strings from dd where trim(logic) <> ''),""" + r"""
marked as (
  select field, strings, regexp_extract_all(
    regexp_replace(logic, '''[^'']*''|"[^"]*"', '§', 'g'),
    '(?:<>|>=|<=|!=|=|<|>)\s*(?:§|[+-]?\.?\w+(?:\.\w+)*)|§|(?:\[\w+(?:\([^()\]]*\))?\]\s*)+|<>|>=|<=|!=|=|<|>|\w+(?:\.\w+)*|[()]') as toks
  from quoted),
numbered as (
  select field, i - 1 as pos, toks[i] as tok, strings[len(list_filter(toks[1:i], lambda t: contains(t, '§')))] as own
  from (select *, unnest(range(1, len(toks) + 1)) as i from marked))
select field, pos,
       case when tok[1] = '[' then 'variable' when tok = '§' then 'string' when tok in ('(', ')') then 'paren'
            when tok in ('<>', '>=', '<=', '!=', '=', '<', '>') then 'operator'
            when tok[1] in ('<', '>', '=', '!') then 'comparison'
            when lower(tok) in ('and', 'or', 'not') then 'gate' else 'word' end as kind,
       nullif(regexp_extract(tok, '^(<>|>=|<=|!=|=|<|>)', 1), '') as op,
       case when tok[1] = '[' then regexp_replace(regexp_replace(trim(tok), '\]\s*\[', ':', 'g'), '^\[|\]$', '', 'g')
            when contains(tok, '§') then substr(own, 2, length(own) - 2)
            when tok in ('<>', '>=', '<=', '!=', '=', '<', '>') then tok
            when tok[1] in ('<', '>', '=', '!') then regexp_replace(tok, '^[<>=!]+\s*', '')
            when lower(tok) in ('and', 'or', 'not') then lower(tok) else tok end as text
from numbered"""

_MISSING = "('f3', 'f10', 'f17', 'f24')"
VALIDATION_TABLE = _with(*PART, f"""v as (
  select field, case when field in {_MISSING} then 'number' else vtype end as vtype, vmin, vmax
  from dd where vtype is not null or vmin is not null or vmax is not null or field in {_MISSING})""") + f"""
select field, vtype, vmin, vmax,
       case when vtype in ('integer', 'number', 'number_1dp', 'yesno') then try_cast(vmin as double) end as min_num,
       case when vtype in ('integer', 'number', 'number_1dp', 'yesno') then try_cast(vmax as double) end as max_num,
       case when vtype in ('date_mdy', 'date_dmy') then {_date('vmin')} end as min_ts,
       case when vtype in ('date_mdy', 'date_dmy') then {_date('vmax')} end as max_ts
from v"""

FIELD_MAP = _with(*PART, """fm as (
  select field as key, label as value, 0 as dir, ord from dd
  union all select label, field, 1, ord from dd)""") + """
select key, value from (
  select key, value, row_number() over (partition by key order by dir desc, ord desc) as rn
  from fm where key is not null) where rn = 1"""

TYPE_COUNTS = _with(*PART) + "select ftype, count(*) as n_fields from dd where ftype is not null group by ftype"

FIELD_SPAN = _with(*PART, "p as (select field, row_number() over (order by ord) - 1 as pos from dd)") + """
select field, pos, pos >= 100 and pos < 900 as in_span from p"""

FIELD_FLAGS = _with(*PART) + """
select field, coalesce(required = 'y', false) as is_required, coalesce(ftype = 'checkbox', false) as is_checkbox,
       coalesce(starts_with(vtype, 'date'), false) as is_date
from dd"""

_NAMES = """names as (
  select field as name from dd where ftype is null or ftype <> 'checkbox'
  union all
  select c.field || '___' || replace(c.code, '-', '_') from choice c
  where c.field in (select field from dd where ftype = 'checkbox')
  union all
  select distinct lower(replace(form, '#', '')) || '_complete' from dd where form is not null)"""
_ALLOWED = "('redcap_event_name', 'brand1_complete', 'brand2_complete', 'brand3_complete')"
COLUMN_TYPES = _with(*PART, _NAMES, f"""j as (
  select n.name as column_name, split_part(n.name, '___', 1) as base_field, d.ftype
  from names n left join dd d on d.field = split_part(n.name, '___', 1))""", f"""t as (
  select column_name, base_field,
         case when ftype is not null then ftype when base_field in {_ALLOWED} then 'category' end as redcap_type
  from j)""") + """
select column_name, base_field, redcap_type,
       case redcap_type when 'radio' then 'double' when 'text' then 'string' when 'checkbox' then 'double'
            when 'dropdown' then 'double' when 'yesno' then 'double' when 'descriptive' then 'string'
            when 'calc' then 'double' when 'category' then 'string' end as spark_type,
       coalesce(redcap_type in ('radio', 'text', 'checkbox', 'dropdown', 'yesno', 'descriptive', 'calc', 'category'),
                false) as known
from t"""

FIELDS_BY_NAMES = _with(*PART, _NAMES) + """
select field, ftype from dd where field in (select split_part(name, '___', 1) from names)"""

_demo_guard, _demo_sel, _demo_join = _recoded(["gender", "site", "ibd"], "codes")
_DEMO_CODES = f"""codes as (
  select subid, redcap_event_name, {_code('gender')} as gender, {_code('site')} as site, {_code('ibd')} as ibd,
         age, balance,
         gender is null and site is null and ibd is null and age is null and balance is null as empty
  from dump)"""
_RACE = """boxes as (
  unpivot (select subid, redcap_event_name, race___1, race___2, race____1 from dump)
  on race___1, race___2, race____1 into name box value checked),
race as (
  select t.subid, t.redcap_event_name, c.label as race
  from (select subid, redcap_event_name, replace(split_part(box, '___', 2), '_', '-') as code
        from boxes where checked = 1) t
  left join choice c on c.field = 'race' and c.code = t.code
  union
  select subid, redcap_event_name, lower(race_oth) from dump where race_oth is not null)"""

SCHEMA_TABLE = _with(*CUSTOMER, _DEMO_CODES.replace(" and balance is null", "").replace(
    "age, balance,", "age,"), _demo_guard, f"""demo as (
  select distinct s.subid, s.redcap_event_name, {_demo_sel}, cast(s.age as double) as age
  from codes s {_demo_join} where not s.empty)""", _RACE) + """
select distinct * from (
  select 'demo' as table_name, 'subid' as column_name, 'bigint' as dtype, null as category
  union all select 'demo', 'age', 'double', null
  union all select 'demo_race', 'subid', 'bigint', null
  union all select 'demo', 'redcap_event_name', 'string', redcap_event_name from demo where redcap_event_name is not null
  union all select 'demo', 'gender', 'string', gender from demo where gender is not null
  union all select 'demo', 'site', 'string', site from demo where site is not null
  union all select 'demo', 'ibd', 'string', ibd from demo where ibd is not null
  union all select 'demo_race', 'redcap_event_name', 'string', redcap_event_name from race
  union all select 'demo_race', 'race', 'string', race from race where race is not null)"""

REGISTERED_SQL = _with(*CUSTOMER, _DEMO_CODES, _demo_guard, f"""demo as (
  select distinct cast(s.subid as varchar) as subid, s.redcap_event_name, {_demo_sel},
         cast(s.age as double) as age, s.balance
  from codes s {_demo_join} where not s.empty)""", _RACE) + """
select d.subid, d.redcap_event_name, d.gender, d.site, d.age, r.race
from demo d left join race r on cast(r.subid as varchar) = d.subid and r.redcap_event_name = d.redcap_event_name"""

_smp_guard, _smp_sel, _smp_join = _recoded(["sampletype"], "codes")
BIOREPOSITORY_ROUND_TRIP = _with(f"dump as ({fx.ORDERS_SAMPLES_SQL})", _dd(fx.ORDERS_SAMPLES_DICT_SQL), CHOICE,
                                 f"""codes as (
  select biorepidnumber, {_code('sampletype')} as sampletype, samplenumber,
         {_date('sample_date')} as sample_date,
         sampletype is null and samplenumber is null and sample_date is null as empty
  from dump)""", _smp_guard) + f"""
select distinct s.biorepidnumber, {_smp_sel}, s.samplenumber, s.sample_date
from codes s {_smp_join} where s.biorepidnumber is not null and not s.empty"""

UNPIVOT_CHECKBOX = _with(*CUSTOMER) + """
unpivot (select subid, redcap_event_name, race___1, race___2, race____1 from dump)
on race___1, race___2, race____1 into name box value checked"""

CATEGORY_COLUMNS = _with(*CUSTOMER) + " union all\n".join(
    f"select '{c}' as column_name, count(distinct {c}) as n_values from dump"
    for c in ("redcap_event_name", "gender", "site", "race___1", "race___2", "race____1", "ibd"))

RAW_EDGES = _with(*PART) + "select field as field_name, logic as branch_logic from dd"

# An independent reading of a date: split into its numbers, then made.
_VISIT = """(select try_cast(case when position('/' in v) > 0
    then split_part(v, '/', 3) || '-' || lpad(split_part(v, '/', 1), 2, '0') || '-' || lpad(split_part(v, '/', 2), 2, '0')
    else v end as date) from (select visit_date as v))"""
DATE_RANGE_CHECK = _with(*ORDERS, f"d as (select visit_date, {_VISIT} as day from dump)") + """
select 'visit_date' as field, 'required' as rule, count(*) filter (where visit_date is null) as n_bad from d
union all select 'visit_date', 'type', count(*) filter (where visit_date is not null and day is null) from d
union all select 'visit_date', 'range', count(*) filter (where day not between date '1995-01-01' and date '2000-12-31') from d"""

RECODE_REPORT = f"""
select 'gender' as field, 'unknown_code' as rule, count(*) filter (where gender > 2) as n_bad from ({fx.CUSTOMER_DUMP_SQL})
union all select 'site', 'unknown_code', count(*) filter (where site > 1) from ({fx.CUSTOMER_DUMP_SQL})
union all select 'ibd', 'unknown_code', count(*) filter (where ibd > 1) from ({fx.CUSTOMER_DUMP_SQL})
union all select 'priority', 'unknown_code', count(*) filter (where priority not between 1 and 5) from ({fx.ORDERS_DUMP_SQL})
union all select 'paid', 'unknown_code', count(*) filter (where paid > 2) from ({fx.ORDERS_DUMP_SQL})
union all select 'visit_date', 'bad_date', count(*) filter (where visit_date is not null and {_VISIT} is null)
          from ({fx.ORDERS_DUMP_SQL})"""

ALL_CHECKS = """
select l_returnflag, count(*) as n_rows,
       not exists (select 1 from lineitem where not l_quantity > 0 or l_quantity is null) as all_positive,
       not exists (select 1 from lineitem where not l_discount < 0.05 or l_discount is null) as all_low_discount
from lineitem group by l_returnflag"""

REGISTERED_CHECKS = _with(*CUSTOMER) + """
select 'balance' as field, 'whole' as rule, count(*) filter (where position('.' in balance) > 0) as n_bad from dump
union all select 'race_oth', 'short', count(*) filter (where length(race_oth) < 19) from dump
union all select 'age', 'two_digits', count(*) filter (where position('.' in age) > 0) from dump"""

# Trailing P, M, D and F runs, taken off one letter after the other.
BATCH_ASSETS = _with(f"f as ({fx.CUSTOMER_FILES_SQL})") + """
select file_name, 'file:/data/b1' as directory, 'REGENERON1' as batch_code, 'VCF' as file_type, 'WES' as assay_type,
       file_key as bytes, rtrim(rtrim(rtrim(rtrim(split_part(file_name, '_', 2), 'P'), 'M'), 'D'), 'F') as subject_id,
       true as own_hash, true as same_hash
from f"""

SORTED_FILES = "select count(*) as n_rows, 0 as n_unsorted from orders"

# What a CSV reader without a schema gives: text.
MISNAMED_FILES = f"""
select cast(subid as varchar) as subid, redcap_event_name, cast(site as varchar) as site, race_oth, age
from ({fx.CUSTOMER_DUMP_SQL})"""

ORDERED_DICTIONARY = _with(*PART) + "select ord - (select min(p_partkey) from part) as ord, field, form, hdr from dd"

_KEPT = "case when {c} = trunc({c}) then cast(cast({c} as bigint) as varchar) else cast({c} as varchar) end"
_FAILING = [
    ("subid", "required", "cast(subid as varchar)", "subid is null"),
    *[(c, "choice", _KEPT.format(c=c), f"{c} is not null and not coalesce(trunc({c}) between 0 and {high}, false)")
      for c, high in (("gender", 2), ("site", 1), ("ibd", 1))],
    *[(c, "required", "null", f"{c} is null") for c in ("gender", "ibd", "age")],
    ("age", "type", "age", "age is not null and try_cast(age as double) is null"),
    ("age", "range", "age", "try_cast(age as double) not between 0 and 20"),
    ("balance", "type", "balance", "balance is not null and try_cast(balance as double) is null"),
    ("balance", "decimals", "balance", r"balance is not null and not regexp_full_match(balance, '[+-]?\d+(\.\d\d)?')"),
    ("balance", "range", "balance", "try_cast(balance as double) not between 0 and 5000")]
_FAILING_ORDERS = [
    ("subid", "required", "subid", "subid is null"), ("priority", "required", "null", "priority is null"),
    *[(c, "choice", _KEPT.format(c=c), f"{c} is not null and not coalesce(trunc({c}) between {low} and {high}, false)")
      for c, low, high in (("priority", 1, 5), ("paid", 0, 2))],
    ("total", "type", "total", "total is not null and try_cast(total as double) is null"),
    ("total", "range", "total", "try_cast(total as double) not between 1000 and 500000"),
    ("visit_date", "required", "null", "visit_date is null"),
    ("visit_date", "type", "visit_date", f"visit_date is not null and {_VISIT} is null"),
    ("visit_date", "range", "visit_date", f"{_VISIT} not between date '1995-01-01' and date '2000-12-31'")]


def _values(source: str, cells: list[tuple[str, str, str, str]]) -> str:
    return " union all ".join(f"select '{f}' as field, '{r}' as rule, {v} as value from ({source}) where {bad}"
                              for f, r, v, bad in cells)


OFFENDING_VALUES = _with(*PART, f"""failing as (
{_values(fx.CUSTOMER_DUMP_SQL, _FAILING)}
union all {_values(fx.ORDERS_DUMP_SQL, _FAILING_ORDERS)}
union all select field, 'malformed_choice', item from ch_parsed where not valid and not blank)""") + """
select field, rule, value, count(*) as n from failing group by field, rule, value"""

TOP_OFFENDERS = f"""
select * from (
  select field, rule, row_number() over (partition by field, rule order by n desc, value nulls first) as place, value, n
  from ({OFFENDING_VALUES})) where place <= 3"""

CLUSTERED_FILES = ("select count(*) as n_rows, cast(0 as bigint) as n_unsorted, cast(0 as bigint) as n_overlapping, "
                   "cast(0 as bigint) as n_oversized from orders")

_TEXT = {c: f"cast({c} as varchar)" for c in ("gender", "site", "race_oth", "age")}
CATEGORY_CODES = f"with dump as ({fx.CUSTOMER_DUMP_SQL})\nselect subid, " + ", ".join(
    f"case when {c} is null then -1 else dense_rank() over (order by {v} nulls last) - 1 end as {c}_code"
    for c, v in _TEXT.items()) + ", true as same from dump"

PUBLISHED_SET = _with(*CUSTOMER, _DEMO_CODES.replace(" and balance is null", "").replace(
    "age, balance,", "age,"), _demo_guard, f"""demo as (
  select distinct s.subid, s.redcap_event_name, {_demo_sel}, cast(s.age as double) as age
  from codes s {_demo_join} where not s.empty)""", _RACE) + """
select cast(2 as bigint) as version, 'demo' as table_name, count(*) as n_rows from demo
union all select 2, 'demo_race', count(*) from race"""

ORACLES: dict[str, str] = {
    "clustered_files": CLUSTERED_FILES,
    "category_codes": CATEGORY_CODES,
    "published_set": PUBLISHED_SET,
    "streamed_md5": CONTENT_MD5,
    "asset_batches": ASSET_BATCHES,
    "offending_values": OFFENDING_VALUES,
    "top_offenders": TOP_OFFENDERS,
    "misnamed_files": MISNAMED_FILES,
    "ordered_dictionary": ORDERED_DICTIONARY,
    "unpivot_checkbox": UNPIVOT_CHECKBOX,
    "category_columns": CATEGORY_COLUMNS,
    "raw_edges": RAW_EDGES,
    "date_range_check": DATE_RANGE_CHECK,
    "recode_report": RECODE_REPORT,
    "all_checks": ALL_CHECKS,
    "registered_checks": REGISTERED_CHECKS,
    "batch_assets": BATCH_ASSETS,
    "sorted_files": SORTED_FILES,
    "registry_tables": spec_exports.tables_sql(registry_profile()),
    "biorepository_tables": spec_exports.tables_sql(biorepository_profile()),
    "profile_report": spec_exports.report_sql(registry_profile()),
    "sample_report": spec_exports.report_sql(biorepository_profile()),
    "checkbox_table": CHECKBOX_TABLE,
    "stream_checkbox_table": CHECKBOX_TABLE,
    "recode": RECODE,
    "choices": CHOICES,
    "choices_strict": CHOICES_STRICT,
    "malformed_choices": MALFORMED_CHOICES,
    "section_header": SECTION_HEADER,
    "branch_edges": BRANCH_EDGES,
    "logic_values": LOGIC_VALUES,
    "logic_tokens": LOGIC_TOKENS,
    "validation_table": VALIDATION_TABLE,
    "field_map": FIELD_MAP,
    "type_counts": TYPE_COUNTS,
    "field_span": FIELD_SPAN,
    "field_flags": FIELD_FLAGS,
    "column_types": COLUMN_TYPES,
    "fields_by_names": FIELDS_BY_NAMES,
    "subject_id": SUBJECT_ID,
    "batch_subject": BATCH_SUBJECT,
    "parent_table": PARENT_TABLE,
    "subject_events": SUBJECT_EVENTS,
    "date_recast": DATE_RECAST,
    "range_check": RANGE_CHECK,
    "decimals_check": DECIMALS_CHECK,
    "required_check": REQUIRED_CHECK,
    "column_report": COLUMN_REPORT,
    "membership": MEMBERSHIP,
    "drop_null_key": DROP_NULL_KEY,
    "assets": ASSETS,
    "content_md5": CONTENT_MD5,
    "schema_table": SCHEMA_TABLE,
    "registered_sql": REGISTERED_SQL,
    "biorepository_round_trip": BIOREPOSITORY_ROUND_TRIP,
}

# Queries checked on rows only (none at present).
ROWS_ONLY: tuple[str, ...] = ()
