"""formweave: dictionary-driven normalisation of wide form exports on Spark.

A data dictionary (one row per field) describes a very wide export (one
column per field, one ``base___code`` column per checkbox option).  The
library compiles the dictionary into column expressions and lazy
DataFrame plans: typed reads, code-to-label recoding, checkbox unfolding
into child tables, validation reports, the branching-logic graph, and
file asset tables.  Everything runs as built-in Spark SQL expressions; no
Python UDF sits on a hot path.

The names below are the public entry points; import them lazily from here
or from their modules.
"""

from formweave.session import get_spark, work_dir

_API = {
    "read_dictionary": "formweave.sources.dictionary",
    "prepare_dictionary": "formweave.sources.dictionary",
    "read_dump": "formweave.sources.dump",
    "load_csv": "formweave.sources.dump",
    "write_tables": "formweave.sources.sinks",
    "register_tables": "formweave.sources.sinks",
    "save_as_tables": "formweave.sources.sinks",
    "choice_table": "formweave.operators.metadata",
    "validation_table": "formweave.operators.metadata",
    "field_map": "formweave.operators.metadata",
    "recode_columns": "formweave.operators.recode",
    "checkbox_table": "formweave.operators.checkbox",
    "check_columns": "formweave.operators.validate",
    "build_graph": "formweave.operators.graph",
    "asset_table": "formweave.operators.assets",
    "content_md5": "formweave.operators.assets",
    "parse_subject_id": "formweave.functions.subject_id",
    "CompiledDictionary": "formweave.plans.compiled",
    "TableSpec": "formweave.plans.tables",
    "build_table": "formweave.plans.tables",
    "build_tables": "formweave.plans.tables",
    "schema_table": "formweave.plans.tables",
    "LoadProfile": "formweave.plans.profiles",
    "run_profile": "formweave.plans.profiles",
    "registry_profile": "formweave.plans.specs",
    "biorepository_profile": "formweave.plans.specs",
}

__all__ = ["get_spark", "work_dir", *_API]
__version__ = "0.1.0"


def __getattr__(name):
    if name in _API:
        import importlib
        return getattr(importlib.import_module(_API[name]), name)
    raise AttributeError(name)
