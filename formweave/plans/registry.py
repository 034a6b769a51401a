"""Registered queries: each takes ``(spark, sf_dir)`` and returns a lazy
DataFrame over the benchmark tables (or inputs Spark derives from them).

Every query has an oracle in :mod:`formweave.plans.oracles` unless it is
marked rows-only there.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from formweave.functions.nulls import is_in, nan_to_str, not_in
from formweave.functions.paths import SUBJECT_PARSERS, path_hash, stem, subject_from_second_token
from formweave.functions.subject_id import parse_subject_id
from formweave.operators import graph, metadata
from formweave.operators.assets import asset_rows, asset_table, content_md5
from formweave.operators.category import decode, encode, value_dictionary
from formweave.operators.checkbox import checkbox_table, unpivot_checkbox
from formweave.operators.recode import recode_columns
from formweave.operators.typing import category_columns, column_types, dump_schema, recast
from formweave.operators.validate import (all_true, check_columns, decimals_check, is_number_ndp, numeric_bounds,
                                          offending_values, range_report, recode_report, register_check, required_report,
                                          top_offenders, verify_all)
from formweave.plans import fixtures as fx
from formweave.plans.compiled import CompiledDictionary
from formweave.plans.specs import biorepository_profile, registry_profile
from formweave.plans.tables import TableSpec, build_parent, build_table, schema_table
from formweave.sources.dictionary import prepare_dictionary
from formweave.sources.dump import drop_all_null, drop_null_key, normalize_nulls

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fields given a validation type by the load profile in the part-derived
# dictionary query (the Registry profile does the same for its lab fields).
PART_MISSING_TYPES = {"number": ["f3", "f10", "f17", "f24"]}
# Export columns allowed without a dictionary field in ``column_types``.
PART_ALLOWED_EXTRA = ["redcap_event_name", "brand1_complete", "brand2_complete", "brand3_complete"]


def _view(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for n in names:
        spark.read.parquet(f"{sf_dir}/{n}.parquet").createOrReplaceTempView(n)


def _fixture(spark: SparkSession, sf_dir: str, name: str, tables: tuple[str, ...]) -> DataFrame:
    _view(spark, sf_dir, *tables)
    return spark.sql(fx.views_sql(name))


def customer_dump(spark, sf_dir):
    return normalize_nulls(_fixture(spark, sf_dir, "customer_dump", ("customer",)))


def customer_dict(spark):
    return prepare_dictionary(spark.sql(fx.CUSTOMER_DICT_SQL))


def orders_dump(spark, sf_dir):
    return normalize_nulls(_fixture(spark, sf_dir, "orders_dump", ("orders",)))


def orders_dict(spark):
    return prepare_dictionary(spark.sql(fx.ORDERS_DICT_SQL))


def part_dict(spark, sf_dir):
    return prepare_dictionary(_fixture(spark, sf_dir, "part_dict", ("part",)))


def _customer(spark, sf_dir):
    dump = customer_dump(spark, sf_dir)
    compiled = CompiledDictionary.compile(customer_dict(spark), dump.columns)
    return dump, compiled


def _orders(spark, sf_dir):
    raw = orders_dump(spark, sf_dir)
    compiled = CompiledDictionary.compile(orders_dict(spark), raw.columns)
    typed, _ = recast(raw, compiled)
    return raw, typed, compiled


# --- queries over the customer export -------------------------------------

def q_checkbox_table(spark, sf_dir):
    """N2 (flagship): ticked race options plus lower-cased free text."""
    dump, compiled = _customer(spark, sf_dir)
    return checkbox_table(dump, fx.CUSTOMER_KEYS, "race", compiled.choices["race"], other_col="race_oth")


def q_unpivot_checkbox(spark, sf_dir):
    """The options of a checkbox field as rows."""
    return unpivot_checkbox(customer_dump(spark, sf_dir), fx.CUSTOMER_KEYS, "race")


def q_category_columns(spark, sf_dir):
    """The customer export's category columns, with their distinct values."""
    dump, compiled = _customer(spark, sf_dir)
    _, rtypes = dump_schema(dump.columns, compiled, ("redcap_event_name",))
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in category_columns(rtypes)]
    return (dump.select(F.inline(F.array(*cells))).where("value is not null").groupBy("column_name")
            .agg(F.count_distinct("value").alias("n_values")))


def q_recode(spark, sf_dir):
    """J1 with the whole-column guard (``site`` stays codes)."""
    dump, compiled = _customer(spark, sf_dir)
    t = dump.select(*fx.CUSTOMER_KEYS, "gender", "site", "ibd")
    return recode_columns(t, ["gender", "site", "ibd"], compiled, guard_source=dump)


def q_required_check(spark, sf_dir):
    """V4: nulls of required fields."""
    dump, compiled = _customer(spark, sf_dir)
    return required_report(dump, compiled)


def q_column_report(spark, sf_dir):
    """V2/V5/V6: every applicable rule of every column."""
    dump, compiled = _customer(spark, sf_dir)
    return check_columns(dump, compiled)


def q_membership(spark, sf_dir):
    """P12 and S10 on the customer export."""
    dump = customer_dump(spark, sf_dir)
    segs = ["BUILDING", "MACHINERY"]
    return dump.select(
        "subid",
        is_in(F.col("redcap_event_name"), segs).alias("in_set"),
        not_in(F.col("site").cast("string"), ["1.0", "2.0"]).alias("site_not_in"),
        nan_to_str(F.col("race_oth")).alias("other_text"),
        nan_to_str(F.col("gender"), numeric=True).alias("gender_text"),
    )


def q_drop_null_key(spark, sf_dir):
    """P4 + P3: rows with a key and at least one value."""
    dump = customer_dump(spark, sf_dir).withColumn(
        "subid", F.when(F.col("subid") % 8 != 0, F.col("subid")))
    t = drop_null_key(dump, ["subid"]).select("subid", "redcap_event_name", "gender", "site", "race_oth")
    return drop_all_null(t, ["gender", "site", "race_oth"])


def _customer_tables(spark, sf_dir):
    dump, compiled = _customer(spark, sf_dir)
    spec = TableSpec("demo", ("gender", "site", "ibd", "age"), {"race": "race_oth"})
    return build_table(dump, spec, fx.CUSTOMER_KEYS, compiled), compiled


def q_schema_table(spark, sf_dir):
    """T7 (tall) over the tables built from the customer export."""
    tables, compiled = _customer_tables(spark, sf_dir)
    return schema_table(tables, compiled, {"demo_race": {"race"}}, extra_categorical=("redcap_event_name",))


def q_registered_sql(spark, sf_dir):
    """T1/T3/T4/T8/T9/N3/N11 round trip through files in the shared work folder."""
    from formweave.plans.roundtrip import customer_round_trip
    return customer_round_trip(spark, sf_dir)


def q_stream_checkbox_table(spark, sf_dir):
    """N2 on Structured Streaming: the customer table read as a file stream,
    unfolded with streaming de-duplication, run to completion (available-now
    trigger) into the shared work folder, and read back."""
    from formweave.session import work_dir
    from formweave.streaming.unfold import unfold_stream
    _, compiled = _customer(spark, sf_dir)
    schema = spark.read.parquet(f"{sf_dir}/customer.parquet").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/customer*.parquet")
    # the time the rows arrive bounds the de-duplication state by a watermark
    stream = stream.withColumn("arrived", F.col("_metadata.file_modification_time"))
    stream.createOrReplaceTempView("customer_stream")
    dump = normalize_nulls(spark.sql(fx.CUSTOMER_DUMP_SQL.replace("select c_custkey", "select arrived, c_custkey", 1)
                                     .replace("from customer", "from customer_stream")))
    out = unfold_stream(dump, fx.CUSTOMER_KEYS, "race", compiled.choices["race"], other_col="race_oth",
                        event_time="arrived").drop("arrived")
    folder = work_dir(spark, "stream")
    q = (out.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", f"{folder}/checkpoint")
         .trigger(availableNow=True).start(f"{folder}/out"))
    q.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def q_biorepository_round_trip(spark, sf_dir):
    """N10 profile run (repeated and missing keys) through files in the shared work folder."""
    from formweave.plans.roundtrip import samples_round_trip
    return samples_round_trip(spark, sf_dir)


# --- queries over the orders export ---------------------------------------

def q_parent_table(spark, sf_dir):
    """N3 parent: project, drop empty rows, recode, cast, de-duplicate."""
    raw, typed, compiled = _orders(spark, sf_dir)
    return build_parent(typed, fx.ORDERS_KEYS, ["priority", "paid", "total", "visit_date"], compiled,
                        guard_source=typed)


def q_subject_events(spark, sf_dir):
    """N3 + P6: the event column is dropped after de-duplication."""
    raw, typed, compiled = _orders(spark, sf_dir)
    spec = TableSpec("subject", ("priority", "paid"), drop_after=("redcap_event_name",))
    return build_table(typed, spec, fx.ORDERS_KEYS, compiled)["subject"]


def q_date_recast(spark, sf_dir):
    """Date text to timestamps; unparsable text is null."""
    raw = orders_dump(spark, sf_dir).withColumn("visit_date_raw", F.col("visit_date"))
    compiled = CompiledDictionary.compile(orders_dict(spark), raw.columns)
    typed, _ = recast(raw, compiled)
    return typed.select("subid", "redcap_event_name", "visit_date_raw", "visit_date")


def q_date_range_check(spark, sf_dir):
    """V2/V3/V6 on dates: bad dates, and dates outside the typed bounds."""
    raw = orders_dump(spark, sf_dir)
    report = check_columns(raw, CompiledDictionary.compile(orders_dict(spark), raw.columns))
    return report.where("field = 'visit_date'")


def q_recode_report(spark, sf_dir):
    """V5: unknown codes and unparsable dates, of two exports."""
    customers, compiled = _customer(spark, sf_dir)
    raw = orders_dump(spark, sf_dir)
    return recode_report(customers, compiled).unionByName(
        recode_report(raw, CompiledDictionary.compile(orders_dict(spark), raw.columns)))


def _offending(spark, sf_dir):
    customers, compiled = _customer(spark, sf_dir)
    raw = orders_dump(spark, sf_dir)
    return (offending_values(customers, compiled, part_dict(spark, sf_dir))
            .unionByName(offending_values(raw, CompiledDictionary.compile(orders_dict(spark), raw.columns))))


def q_offending_values(spark, sf_dir):
    """V5: the values behind failed checks of two exports, and malformed choice
    items, with their counts."""
    return _offending(spark, sf_dir)


def q_top_offenders(spark, sf_dir):
    """V5: the three most frequent of them per field and rule."""
    return top_offenders(_offending(spark, sf_dir), 3)


def q_registry_tables(spark, sf_dir):
    """All 21 Registry specifications (and their children) over a
    derived export of full width, through files, from one pass."""
    from formweave.plans import roundtrip
    return roundtrip.spec_tables(spark, sf_dir, registry_profile())


def q_biorepository_tables(spark, sf_dir):
    """All three Biorepository specifications, through files."""
    from formweave.plans import roundtrip
    return roundtrip.spec_tables(spark, sf_dir, biorepository_profile())


def q_profile_report(spark, sf_dir):
    """V5/V6/S12/N7 of a profile run: forced lab types, date bounds, bad dates
    and unknown codes, counted on the text as read."""
    from formweave.plans import roundtrip
    return roundtrip.spec_report(spark, sf_dir, registry_profile())


def q_sample_report(spark, sf_dir):
    """The same for the Biorepository profile, with the rows dropped for a
    missing key."""
    from formweave.plans import roundtrip
    return roundtrip.spec_report(spark, sf_dir, biorepository_profile())


# Fixed value: rows of one written file, which one task sorts.
FILE_ROWS = 250_000


def q_sorted_files(spark, sf_dir):
    """O1: rows of written tables, and rows that stand before a smaller key in
    their file."""
    from formweave.session import work_dir
    from formweave.sources.sinks import write_tables
    _view(spark, sf_dir, "orders")
    # A task sorts and checks one file, so their number follows the rows; a few
    # order states cannot divide them.
    orders = spark.table("orders")
    n_files = max(4, 1 + orders.count() // FILE_ROWS)
    table = orders.select("o_custkey", "o_orderkey", "o_orderstatus").repartition(n_files)
    path = write_tables({"orders": table}, work_dir(spark, "sorted"), sort_keys=("o_custkey", "o_orderkey"))["orders"]
    rows = spark.read.parquet(path).select("o_custkey", "o_orderkey", F.col("_metadata.file_path").alias("file"),
                                           F.col("_metadata.row_index").alias("at")).repartition(n_files, "file")
    key = F.struct("o_custkey", "o_orderkey")
    before = F.lag(key).over(Window.partitionBy("file").orderBy("at"))
    return rows.select(F.coalesce(before > key, F.lit(False)).alias("unsorted")).agg(
        F.count("*").alias("n_rows"), F.count_if("unsorted").alias("n_unsorted"))


def q_clustered_files(spark, sf_dir):
    """O1: a table in key-range files, its first key with three values only:
    rows before a smaller one in their file, files that overlap in order, and
    files of more than twice their share."""
    from formweave.session import work_dir
    from formweave.sources.sinks import write_tables
    _view(spark, sf_dir, "orders")
    table = spark.table("orders").select("o_orderstatus", "o_orderpriority", "o_orderkey")
    keys, n_files = ("o_orderstatus", "o_orderpriority"), max(8, 1 + table.count() // FILE_ROWS)
    path = write_tables({"orders": table}, work_dir(spark, "clustered"), sort_keys=keys, files=n_files)["orders"]
    key = F.struct("o_orderstatus", "o_orderpriority", "o_orderkey")
    rows = spark.read.parquet(path).select(key.alias("key"), F.col("_metadata.file_path").alias("file"),
                                           F.col("_metadata.row_index").alias("at")).repartition(n_files, "file")
    before = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
    files = rows.select("file", "key", F.coalesce(before > F.col("key"), F.lit(False)).alias("unsorted")).groupBy("file").agg(
        F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("n"), F.count_if("unsorted").alias("unsorted"))
    follow = Window.orderBy("low")                      # one row per file
    files = files.select("*", F.coalesce(F.lag("high").over(follow) >= F.col("low"), F.lit(False)).alias("overlaps"),
                         F.sum("n").over(Window.partitionBy()).alias("total"))
    return files.agg(F.sum("n").alias("n_rows"), F.sum("unsorted").alias("n_unsorted"), F.count_if("overlaps").alias("n_overlapping"),
                     F.count_if(F.col("n") > 2 * F.col("total") / n_files).alias("n_oversized"))


CATEGORY_COLUMNS_CODED = ["gender", "site", "race_oth", "age"]


def q_category_codes(spark, sf_dir):
    """S16/AG4: categories as codes in order of their values, and whether they
    decode to what they were."""
    dump, _ = _customer(spark, sf_dir)
    cats = CATEGORY_COLUMNS_CODED
    rows = dump.select("subid", *[F.col(c).cast("string").alias(c) for c in cats])
    dictionary = value_dictionary(rows, cats)
    both = encode(rows.select("*", *[F.col(c).alias(f"{c}_was") for c in cats]), cats, dictionary)
    back = decode(both.select("*", *[F.col(c).alias(f"{c}_code") for c in cats]), cats, dictionary)
    same = F.lit(True)
    for c in cats:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_was"))
    return back.select("subid", *[f"{c}_code" for c in cats], same.alias("same"))


def q_published_set(spark, sf_dir):
    """Two runs published one after the other; readers see the second set,
    whole."""
    from formweave.session import work_dir
    from formweave.sources.sinks import publish_tables, read_published
    tables, _ = _customer_tables(spark, sf_dir)
    folder = work_dir(spark, "published")
    publish_tables({n: df.limit(0) for n, df in tables.items()}, folder, run="empty")
    version = publish_tables(tables, folder, run="whole", sort_keys=("subid",))
    parts = [df.groupBy().agg(F.count("*").alias("n_rows")).select(
        F.lit(version).cast("bigint").alias("version"), F.lit(name).alias("table_name"), "n_rows")
        for name, df in sorted(read_published(spark, folder).items())]
    return reduce(DataFrame.unionByName, parts)


# --- queries over lineitem / part / customer columns ----------------------

LINEITEM_BOUNDS_SQL = """
select * from (values
 (0, 'l_quantity', 'text', 'line', null, 'Quantity', null, 'number', '1', '45', null, null),
 (1, 'l_discount', 'text', 'line', null, 'Discount', null, 'number', '0', '0.08', null, null),
 (2, 'l_tax', 'text', 'line', null, 'Tax', null, 'number', null, '0.06', null, null)
) as t(ord, field, ftype, form, hdr, label, choices, vtype, vmin, vmax, logic, required)
"""


def q_range_check(spark, sf_dir):
    """V3: values outside the dictionary bounds (null bound = open)."""
    _view(spark, sf_dir, "lineitem")
    dd = prepare_dictionary(spark.sql(LINEITEM_BOUNDS_SQL))
    li = spark.table("lineitem")
    bounds = numeric_bounds(metadata.validation_table(dd), li.columns)
    return range_report(li, bounds)


PART_PRICE_SQL = """
select p_partkey,
       case when p_partkey % 9 = 0 then cast(p_retailprice as string) || '.5'
            when p_partkey % 14 = 0 then 'a' || cast(p_retailprice as string)
            when p_partkey % 10 = 0 then null
            when p_partkey % 4 = 0 then cast(p_retailprice as string) || '5'
            else cast(p_retailprice as string) end as price_text
from part
"""


def q_decimals_check(spark, sf_dir):
    """V1: one and two decimal places on price text."""
    _view(spark, sf_dir, "part")
    p = spark.sql(PART_PRICE_SQL)
    return p.select("p_partkey", "price_text",
                    is_number_ndp(F.col("price_text"), 1).alias("ok_1dp"),
                    is_number_ndp(F.col("price_text"), 2).alias("ok_2dp"))


def q_all_checks(spark, sf_dir):
    """AG5/V7: checks that must hold on every row; one does, one does not."""
    _view(spark, sf_dir, "lineitem")
    rows = verify_all(spark.table("lineitem"), F.col("l_quantity") > 0, "quantity")
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n_rows")).select(
        "l_returnflag", "n_rows", all_true(rows, F.col("l_quantity") > 0).alias("all_positive"),
        all_true(rows, F.col("l_discount") < 0.05).alias("all_low_discount"))


def q_registered_checks(spark, sf_dir):
    """rules of a check registry, counted with the others."""
    dump, compiled = _customer(spark, sf_dir)
    checks: dict = {}
    register_check("balance", "whole", lambda c: c.contains("."), checks)
    register_check("age", "two_digits", decimals_check(2), checks)
    register_check("race_oth", "short", lambda c: F.length(c) < 19, checks)
    return check_columns(dump, compiled, extra_checks=checks).where("rule in ('whole', 'two_digits', 'short')")


def q_subject_id(spark, sf_dir):
    """Proband and relation from sample identifiers."""
    ids = _fixture(spark, sf_dir, "customer_ids", ("customer",))
    p = parse_subject_id(F.col("biorepidnumber"))
    return ids.select("id_key", "biorepidnumber", p["proband_id"].alias("proband_id"),
                      p["relation_code"].alias("relation_code"), p["relation"].alias("relation"),
                      p["valid"].alias("valid"))


def q_batch_subject(spark, sf_dir):
    """Stem and batch-rule subject id of file names."""
    files = _fixture(spark, sf_dir, "customer_files", ("customer",))
    return files.select("file_key", "file_name", stem(F.col("file_name")).alias("stem"),
                        subject_from_second_token(F.col("file_name")).alias("subject_id"))


def q_batch_assets(spark, sf_dir):
    """Asset rows of a batch with a registered file-name parser,
    and whether their path hashes tell all paths apart."""
    files = _fixture(spark, sf_dir, "customer_files", ("customer",)).select(
        F.concat(F.lit("file:/data/b1/"), F.col("file_name")).alias("path"), F.col("file_key").alias("length"))
    rows = asset_rows(files, "REGENERON1", "VCF", "WES", SUBJECT_PARSERS["REGENERON1"])
    clash = rows.groupBy("path_hash").agg(F.count_distinct("directory", "file_name").alias("paths"))
    return rows.join(clash, "path_hash").select(
        "file_name", "directory", "batch_code", "file_type", "assay_type", "bytes", "subject_id",
        (F.col("paths") == 1).alias("own_hash"), (F.col("path_hash") == path_hash(
            F.concat_ws("/", "directory", "file_name"))).alias("same_hash"))


def q_assets(spark, sf_dir):
    """Asset table of the benchmark files (hash left out: no SQL twin)."""
    conf = {"BATCHES": {"BENCH": {"ASSAY_TYPE": "TABLES",
                                  "FILE_TYPE": {"PARQUET": [f"{sf_dir}/*.parquet"]}}}}
    return asset_table(spark, conf).drop("path_hash")


def q_asset_batches(spark, sf_dir):
    """Two batches, three file types, overlapping globs and globs
    without files, from one listing (hash left out: no SQL twin)."""
    conf = {"BATCHES": {
        "BENCH": {"ASSAY_TYPE": "WES", "FILE_TYPE": {
            "ORDERS": [f"{sf_dir}/orders.parquet", f"{sf_dir}/o*.parquet"],
            "PARTS": [f"{sf_dir}/p*.parquet", f"{sf_dir}/none/*.parquet", f"{sf_dir}/*.vcf"]}},
        "REGENERON1": {"ASSAY_TYPE": "WGS", "FILE_TYPE": {
            "TABLES": [f"{sf_dir}/{{nation,region}}.parquet", f"{sf_dir}/[e-l]*.p?rquet"]}}}}
    return asset_table(spark, conf).drop("path_hash")


def q_streamed_md5(spark, sf_dir):
    """T5: the same digests with every file streamed in pieces."""
    m = content_md5(spark, f"{sf_dir}/*.parquet", inline_max_bytes=0)
    return m.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "bytes", "md5")


def q_content_md5(spark, sf_dir):
    """T5: md5 of every benchmark file."""
    m = content_md5(spark, f"{sf_dir}/*.parquet")
    return m.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "bytes", "md5")


# --- queries over the part-derived dictionary -----------------------------

def q_choices(spark, sf_dir):
    """Tall choice table."""
    return metadata.choice_table(part_dict(spark, sf_dir))


def q_choices_strict(spark, sf_dir):
    """Strict parse, integer codes."""
    return metadata.choice_table_strict(part_dict(spark, sf_dir))


def q_malformed_choices(spark, sf_dir):
    """V5 input: malformed choice items."""
    return metadata.malformed_choices(part_dict(spark, sf_dir))


def q_section_header(spark, sf_dir):
    """E1/AG3: section header filled within each form."""
    return part_dict(spark, sf_dir).select("field", "form", "hdr")


def q_misnamed_files(spark, sf_dir):
    """T4: an export whose files' names tell nothing of their compression."""
    from formweave.plans import roundtrip
    return roundtrip.misnamed_round_trip(spark, sf_dir)


def q_ordered_dictionary(spark, sf_dir):
    """A dictionary in several files keeps the order of the files."""
    from formweave.plans import roundtrip
    return roundtrip.ordered_dictionary(spark, sf_dir)


def q_branch_edges(spark, sf_dir):
    """Branching-logic edges."""
    return graph.build_graph(part_dict(spark, sf_dir))


def q_raw_edges(spark, sf_dir):
    """G1: fields with their branching logic as it stands."""
    return graph.raw_edges(part_dict(spark, sf_dir))


def q_logic_values(spark, sf_dir):
    """Compared values in branching logic."""
    return graph.logic_value_table(part_dict(spark, sf_dir))


def q_logic_tokens(spark, sf_dir):
    """Every token of branching logic as people write it."""
    _view(spark, sf_dir, "part")
    return graph.logic_token_table(spark.sql(fx.PART_LOGIC_SQL))


def q_validation_table(spark, sf_dir):
    """Validation types and typed bounds."""
    return metadata.validation_table(part_dict(spark, sf_dir), PART_MISSING_TYPES)


def q_field_map(spark, sf_dir):
    """U4: name <-> label map, last entry wins."""
    return metadata.field_map(part_dict(spark, sf_dir))


def q_type_counts(spark, sf_dir):
    """AG1: fields per type."""
    return metadata.type_counts(part_dict(spark, sf_dir))


def q_field_span(spark, sf_dir):
    """Position of every field, and membership in a span."""
    dd = part_dict(spark, sf_dir)
    inside = metadata.fields_by_span(dd, 100, 900).select("field", F.lit(True).alias("in_span"))
    return (metadata.field_position(dd).join(inside, "field", "left")
            .select("field", "pos", F.coalesce("in_span", F.lit(False)).alias("in_span")))


def q_field_flags(spark, sf_dir):
    """Required, checkbox and date flags per field."""
    dd = part_dict(spark, sf_dir)
    required = metadata.required_fields(dd).select("field", F.lit(True).alias("is_required"))
    dates = metadata.date_fields(dd).select("field", F.lit(True).alias("is_date"))
    return (metadata.fields_by_type(dd).join(required, "field", "left").join(dates, "field", "left")
            .select("field", F.coalesce("is_required", F.lit(False)).alias("is_required"), "is_checkbox",
                    F.coalesce("is_date", F.lit(False)).alias("is_date")))


def part_export_names(dd: DataFrame) -> DataFrame:
    """Export column names of the part dictionary: one per field, one per
    checkbox option (``base___code``) from the same scan, and one status
    column per form."""
    from formweave.functions import choices as ch
    rows = dd.select("field", "ftype", "form", ch.sorted_valid_items(ch.parse_items(F.col("choices"))).alias("_items"))
    options = F.transform(ch.last_of_code(F.col("_items")),
                          lambda p: F.concat(F.col("field"), F.lit("___"), F.regexp_replace(p["code"], "-", "_")))
    none = F.array().cast("array<string>")
    is_checkbox = F.coalesce(F.col("ftype") == "checkbox", F.lit(False))
    own = F.when(is_checkbox, F.coalesce(options, none)).otherwise(F.array(F.col("field")))
    form = F.concat(F.lower(F.regexp_replace("form", "#", "")), F.lit("_complete"))
    status = F.when(form.isNotNull(), F.array(form)).otherwise(none)
    # fields are numbered, so only the forms' names can be equal
    numbered = F.concat(F.transform(own, lambda n, i: F.struct(n.alias("name"), F.col("field").alias("of"), i.alias("at"))),
                        F.transform(status, lambda n: F.struct(n.alias("name"), F.lit(None).cast("string").alias("of"),
                                                               F.lit(None).cast("int").alias("at"))))
    return rows.select(F.inline(numbered)).distinct().select("name")


def q_column_types(spark, sf_dir):
    """Export column types by base-name lookup."""
    dd = part_dict(spark, sf_dir)
    return column_types(part_export_names(dd), dd, PART_ALLOWED_EXTRA)


def q_fields_by_names(spark, sf_dir):
    """Dictionary rows behind export column names (de-duplicated by base)."""
    dd = part_dict(spark, sf_dir)
    return metadata.fields_by_names(dd, part_export_names(dd)).select("field", "ftype")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "checkbox_table": q_checkbox_table,
    "stream_checkbox_table": q_stream_checkbox_table,
    "recode": q_recode,
    "choices": q_choices,
    "choices_strict": q_choices_strict,
    "malformed_choices": q_malformed_choices,
    "section_header": q_section_header,
    "branch_edges": q_branch_edges,
    "logic_values": q_logic_values,
    "logic_tokens": q_logic_tokens,
    "validation_table": q_validation_table,
    "field_map": q_field_map,
    "type_counts": q_type_counts,
    "field_span": q_field_span,
    "field_flags": q_field_flags,
    "column_types": q_column_types,
    "fields_by_names": q_fields_by_names,
    "subject_id": q_subject_id,
    "batch_subject": q_batch_subject,
    "parent_table": q_parent_table,
    "subject_events": q_subject_events,
    "date_recast": q_date_recast,
    "range_check": q_range_check,
    "decimals_check": q_decimals_check,
    "required_check": q_required_check,
    "column_report": q_column_report,
    "membership": q_membership,
    "drop_null_key": q_drop_null_key,
    "assets": q_assets,
    "content_md5": q_content_md5,
    "schema_table": q_schema_table,
    "registered_sql": q_registered_sql,
    "biorepository_round_trip": q_biorepository_round_trip,
    "unpivot_checkbox": q_unpivot_checkbox,
    "category_columns": q_category_columns,
    "raw_edges": q_raw_edges,
    "date_range_check": q_date_range_check,
    "recode_report": q_recode_report,
    "all_checks": q_all_checks,
    "registered_checks": q_registered_checks,
    "batch_assets": q_batch_assets,
    "sorted_files": q_sorted_files,
    "registry_tables": q_registry_tables,
    "biorepository_tables": q_biorepository_tables,
    "profile_report": q_profile_report,
    "sample_report": q_sample_report,
    "misnamed_files": q_misnamed_files,
    "ordered_dictionary": q_ordered_dictionary,
    "offending_values": q_offending_values,
    "top_offenders": q_top_offenders,
    "asset_batches": q_asset_batches,
    "clustered_files": q_clustered_files,
    "category_codes": q_category_codes,
    "published_set": q_published_set,
    "streamed_md5": q_streamed_md5,
}
