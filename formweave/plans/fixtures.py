"""Inputs derived from the benchmark tables, as SQL text that both Spark
SQL and DuckDB run unchanged.

The benchmark tables hold no form exports, so exports and dictionaries
are derived from them by rule: the work of every query grows with the
tables it reads.  Only the small form dictionaries of the customer and
orders exports are literal (a dictionary describes columns, not rows).
"""

from __future__ import annotations

# Export derived from ``customer``: keys, two radio/dropdown fields, one
# checkbox field with three options (one negative) and its free-text
# column, a yes/no field, and numeric and date text fields.
CUSTOMER_DUMP_SQL = """
select c_custkey as subid, c_mktsegment as redcap_event_name,
       case when c_custkey % 7 = 0 then null else cast(c_custkey % 3 as double) end as gender,
       case when c_custkey % 5 = 0 then null else cast(c_custkey % 6 as double) end as site,
       cast(case when c_custkey % 2 = 0 then 1 else 0 end as double) as race___1,
       cast(case when c_custkey % 3 = 0 then 1 else 0 end as double) as race___2,
       cast(case when c_custkey % 11 = 0 then 1 else 0 end as double) as race____1,
       case when c_custkey % 13 = 0 then upper(c_name) end as race_oth,
       case when c_custkey % 4 = 3 then null else cast(c_custkey % 2 as double) end as ibd,
       case when c_custkey % 9 = 0 then null else cast(c_nationkey as string) end as age,
       case when c_custkey % 10 = 0 then null
            when c_custkey % 10 = 1 then cast(c_acctbal as string)
            else cast(cast(floor(c_acctbal) as bigint) as string) end as balance
from customer
"""

# Dictionary of the customer export (ord, field, ftype, form, hdr, label,
# choices, vtype, vmin, vmax, logic, required).  ``site`` lacks codes 2 to
# 5, so the whole-column guard cancels its recode.
CUSTOMER_DICT_SQL = """
select * from (values
 (0, 'subid', 'text', 'demo', 'Basic', 'Subject', null, null, null, null, null, 'y'),
 (1, 'gender', 'radio', 'demo', null, 'Gender', '0, Female | 1, Male | 2, Other', null, null, null, null, 'y'),
 (2, 'site', 'dropdown', 'demo', null, 'Site', '0, North | 1, South', null, null, null, null, null),
 (3, 'race', 'checkbox', 'demo', null, 'Race', '1, White | 2, Black, or AA | -1, Unknown', null, null, null, '[gender] = "1"', null),
 (4, 'race_oth', 'text', 'demo', null, 'Other race', null, null, null, null, '[race(-1)] = "1"', null),
 (5, 'ibd', 'yesno', 'dx', 'Dx', 'IBD', null, null, null, null, null, 'y'),
 (6, 'note', 'descriptive', 'dx', null, 'Note', null, null, null, null, null, null),
 (7, 'age', 'text', 'dx', null, 'Age', null, 'integer', '0', '20', '[race(2)] = "1" and ([baseline][ibd] >= 5 or [gender]<>"")', 'y'),
 (8, 'balance', 'text', 'dx', null, 'Balance', null, 'number_2dp', '0', '5000', null, null)
) as t(ord, field, ftype, form, hdr, label, choices, vtype, vmin, vmax, logic, required)
"""

CUSTOMER_KEYS = ["subid", "redcap_event_name"]

# Export derived from ``orders``: subject x event keys, a coded priority,
# a number, and a date as text (damaged by rule: an impossible day, a word,
# and the month/day/year layout).
ORDERS_DUMP_SQL = """
select cast(o_custkey as string) as subid, o_orderstatus as redcap_event_name,
       cast(case o_orderpriority when '1-URGENT' then 1 when '2-HIGH' then 2 when '3-MEDIUM' then 3
                 when '4-NOT SPECIFIED' then 4 else 5 end as double) as priority,
       case when o_orderkey % 6 = 0 then null else cast(o_orderkey % 3 as double) end as paid,
       case when o_orderkey % 8 = 0 then null else cast(o_totalprice as string) end as total,
       case when o_orderkey % 17 = 0 then '2016-02-30'
            when o_orderkey % 19 = 0 then 'unknown'
            when o_orderkey % 5 = 0 then cast(month(o_orderdate) as string) || '/' ||
                 cast(day(o_orderdate) as string) || '/' || cast(year(o_orderdate) as string)
            else cast(cast(o_orderdate as date) as string) end as visit_date
from orders
"""

ORDERS_DICT_SQL = """
select * from (values
 (0, 'subid', 'text', 'visit', 'Visit', 'Subject', null, null, null, null, null, 'y'),
 (1, 'priority', 'radio', 'visit', null, 'Priority', '1, Urgent | 2, High | 3, Medium | 4, Not specified | 5, Low', null, null, null, null, 'y'),
 (2, 'paid', 'radio', 'visit', null, 'Paid', '0, No | 1, Partly | 2, Fully', null, null, null, null, null),
 (3, 'total', 'text', 'visit', null, 'Total', null, 'number', '1000', '500000', null, null),
 (4, 'visit_date', 'text', 'visit', null, 'Visit date', null, 'date_mdy', '1995-01-01', '2000-12-31', null, 'y')
) as t(ord, field, ftype, form, hdr, label, choices, vtype, vmin, vmax, logic, required)
"""

ORDERS_KEYS = ["subid", "redcap_event_name"]

# Dictionary derived from ``part``: one field per part.  Forms are brands
# (a few very large forms), field types, choice lists (with duplicate
# codes, malformed items and trailing pipes), validation types and bounds,
# branching logic and required flags all follow the part columns.
PART_DICT_SQL = """
select p_partkey as ord,
       'f' || cast(p_partkey as string) as field,
       p_brand as form,
       case when p_partkey % 7 = 0 then p_type end as hdr,
       case p_size % 8 when 0 then 'radio' when 1 then 'dropdown' when 2 then 'checkbox'
            when 3 then 'yesno' when 4 then 'text' when 5 then 'calc' when 6 then 'descriptive' end as ftype,
       case when p_partkey % 29 = 0 then null else p_name end as label,
       case when p_size % 8 in (0, 1, 2, 5) then
                 '0, ' || p_type || ' | 1, ' || p_name || ', ' || p_brand
                 || case when p_partkey % 5 = 0 then ' | 0, again ' || p_type else '' end
                 || case when p_partkey % 11 = 0 then ' | x' || cast(p_size as string) || ', bad' else '' end
                 || case when p_partkey % 13 = 0 then ' |' else '' end
                 || case when p_partkey % 17 = 0 then ' | -1, None of ' || p_name else '' end
            when p_size % 8 = 3 and p_partkey % 2 = 0 then '0, Nope | 1, Yep'
            when p_size % 8 = 3 and p_partkey % 6 = 1 then 'nan'
       end as choices,
       case when p_size % 8 = 4 then
            case p_partkey % 5 when 0 then 'integer' when 1 then 'number' when 2 then 'number_1dp'
                 when 3 then 'date_mdy' end end as vtype,
       case when p_size % 8 = 4 and p_partkey % 5 < 3 then cast(p_size as string)
            when p_size % 8 = 4 and p_partkey % 5 = 3 then '2000-01-' || cast(10 + p_size % 19 as string)
            when p_size % 8 = 4 and p_partkey % 5 = 4 then 'low' end as vmin,
       case when p_size % 8 = 4 and p_partkey % 5 < 3 and p_partkey % 3 > 0 then cast(p_retailprice as string)
            when p_size % 8 = 4 and p_partkey % 5 = 3 then '2000-02-30' end as vmax,
       case when p_partkey % 3 = 0 then null
            when p_partkey % 3 = 1 then '[f' || cast(p_partkey - 1 as string) || '] = "1"'
            else '[f' || cast(p_partkey - 2 as string) || '(1)] = "1" or [ev' || cast(p_size as string)
                 || '][f' || cast(p_partkey - 1 as string) || '] >= ' || cast(p_size as string)
                 || ' and [f' || cast(p_partkey - 1 as string) || '] <> ""' end as logic,
       case when p_partkey % 4 = 0 then 'y' end as required
from part
"""

# Sample export derived from ``orders``: the sample id repeats (one subject,
# several samples) and is missing on some rows; a coded sample type, a
# sample number, a date as text, a checkbox and a status column.
ORDERS_SAMPLES_SQL = """
select case when o_orderkey % 23 = 0 then null
            else cast(o_custkey as string) || '.' || cast(o_orderkey % 8 as string) end as biorepidnumber,
       cast(case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end as double) as sampletype,
       cast(o_orderkey % 1000 as string) || '.' || cast(o_orderkey % 7 as string) as samplenumber,
       cast(cast(o_orderdate as date) as string) as sample_date,
       cast(case when o_orderkey % 2 = 0 then 1 else 0 end as double) as blood_samples___1,
       cast(case when o_orderkey % 3 = 0 then 1 else 0 end as double) as blood_samples___2,
       '2' as ibd_biorepository_sample_database_complete
from orders
"""

ORDERS_SAMPLES_DICT_SQL = """
select * from (values
 (0, 'biorepidnumber', 'text', 'sample', 'Sample', 'Sample id', null, null, null, null, null, 'y'),
 (1, 'sampletype', 'radio', 'sample', null, 'Sample type', '1, Blood | 2, Stool | 3, Biopsy', null, null, null, null, null),
 (2, 'samplenumber', 'text', 'sample', null, 'Sample number', null, null, null, null, null, null),
 (3, 'sample_date', 'text', 'sample', null, 'Sample date', null, 'date_mdy', null, null, null, null),
 (4, 'blood_samples', 'checkbox', 'sample', null, 'Blood', '1, Serum | 2, Plasma', null, null, null, null, null)
) as t(ord, field, ftype, form, hdr, label, choices, vtype, vmin, vmax, logic, required)
"""

# Subject identifiers derived from ``customer``: plain, proband code,
# relation codes 1 to 9 (1 invalid, 8 and 9 without label), three parts,
# and a trailing delimiter.
CUSTOMER_IDS_SQL = """
select c_custkey as id_key,
       case when c_custkey % 10 = 0 then cast(c_custkey as string)
            when c_custkey % 10 = 8 then cast(c_custkey as string) || '.' || cast(c_nationkey % 3 as string) || '.1'
            when c_custkey % 23 = 0 then cast(c_custkey as string) || '.'
            else cast(c_custkey as string) || '.' || cast(c_custkey % 10 as string) end as biorepidnumber
from customer
"""

# File names of a sequencing batch derived from ``customer``.
CUSTOMER_FILES_SQL = """
select c_custkey as file_key,
       'B' || cast(c_nationkey as string) || '_' || cast(c_custkey as string)
       || case c_custkey % 6 when 0 then 'FPM' when 1 then 'MP' when 2 then 'P' when 3 then 'FDMP'
               when 4 then 'PM' else '' end
       || '_' || c_mktsegment || case when c_custkey % 2 = 0 then '.vcf.gz' else '.bam' end as file_name
from customer
"""


def views_sql(name: str) -> str:
    """Fixture SQL by name."""
    return {
        "customer_dump": CUSTOMER_DUMP_SQL,
        "customer_dict": CUSTOMER_DICT_SQL,
        "orders_dump": ORDERS_DUMP_SQL,
        "orders_dict": ORDERS_DICT_SQL,
        "part_dict": PART_DICT_SQL,
        "customer_ids": CUSTOMER_IDS_SQL,
        "customer_files": CUSTOMER_FILES_SQL,
        "orders_samples": ORDERS_SAMPLES_SQL,
        "orders_samples_dict": ORDERS_SAMPLES_DICT_SQL,
    }[name]

# Branching logic as people write it, one per part: signed codes, signed
# numbers and decimals, brackets, operators and gates inside quotes, quotes
# never closed, event-qualified variables, and literals on the left.
PART_LOGIC_SQL = """
select 'f' || cast(p_partkey as string) as field,
       case p_partkey % 8
            when 0 then '[f' || cast(p_size as string) || '(-1)] = ''1'' and [f1] >= -' || cast(p_size as string) || '.5'
            when 1 then '[a] = "see [b' || cast(p_size as string) || '] here" or ([c]<>"" and not [d] = "x and y")'
            when 2 then '[ev' || cast(p_size as string) || '] [f2(10)] > 2.5 AND [f3]!=.75'
            when 3 then '[f4] = ''it "is" <= ' || cast(p_size as string) || '''  or  [f5] < +' || cast(p_size as string)
            when 4 then '''' || p_brand || ''' = [f6] and [f7] = ' || replace(p_brand, '#', '_')
            when 5 then 'datediff([f8], "today", "d") >= ' || cast(p_size as string) || ' or [f9] = "open'
            when 6 then '[f10(abc)][f11(1.2)] <= 1.2.3 or [no bracket = 4'
            when 7 then '  ' end as logic
from part
"""
