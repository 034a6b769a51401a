"""Driver-side metadata for the columns of one export.

The export's column list is the only thing compiled on the driver: for the
fields behind those columns we collect type, validation and choice entries.
That is bounded by the export's width (its schema) and its fields' option
lists, never by its rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formweave.functions.names import py_base_name
from formweave.operators.metadata import choice_table

@dataclass(frozen=True)
class FieldMeta:
    field: str
    ord: int | None
    ftype: str | None
    vtype: str | None
    vmin: str | None
    vmax: str | None
    required: bool


@dataclass
class CompiledDictionary:
    fields: dict[str, FieldMeta] = field(default_factory=dict)
    choices: dict[str, dict[str, str]] = field(default_factory=dict)

    @classmethod
    def compile(cls, dd: DataFrame, columns: Iterable[str] | None = None) -> "CompiledDictionary":
        """Collect metadata of the fields behind ``columns`` (all fields if None)."""
        sub = dd
        if columns is not None:
            bases = sorted({py_base_name(c) for c in columns})
            sub = dd.filter(F.col("field").isin(*bases)) if bases else dd.limit(0)
        # One job: field rows and choice rows as one union.
        str_null = F.lit(None).cast("string")
        fields = sub.select(F.lit("f").alias("kind"), "field", "ord", "ftype", "vtype", "vmin", "vmax",
                            "required", str_null.alias("code"), str_null.alias("label"))
        choices = choice_table(sub).select(
            F.lit("c").alias("kind"), "field", F.lit(None).cast("bigint").alias("ord"),
            *[str_null.alias(c) for c in ("ftype", "vtype", "vmin", "vmax", "required")], "code", "label")
        got = fields.unionByName(choices).collect()
        rows = [r for r in got if r["kind"] == "f"]
        ch_rows = [r for r in got if r["kind"] == "c"]
        out = cls()
        for r in sorted(rows, key=lambda r: (r["ord"] is None, r["ord"])):
            out.fields[r["field"]] = FieldMeta(r["field"], r["ord"], r["ftype"], r["vtype"],
                                               r["vmin"], r["vmax"], r["required"] == "y")
        for r in ch_rows:
            out.choices.setdefault(r["field"], {})[r["code"]] = r["label"]
        return out

    def with_types(self, missing_types: Mapping[str, Iterable[str]]) -> "CompiledDictionary":
        """The same dictionary with the listed fields' validation types forced
        (the rule of the validation table, N7)."""
        forced = {f: t for t, names in (missing_types or {}).items() for f in names}
        return CompiledDictionary({f: replace(m, vtype=forced.get(f, m.vtype)) for f, m in self.fields.items()}, self.choices)

    def ftype(self, name: str) -> str | None:
        meta = self.fields.get(py_base_name(name))
        return meta.ftype if meta else None

    def vtype(self, name: str) -> str | None:
        meta = self.fields.get(name)
        return meta.vtype if meta else None

    def date_fields(self) -> list[str]:
        """P16 on the compiled fields."""
        return [f for f, m in self.fields.items() if (m.vtype or "").startswith("date")]

    def required(self) -> list[str]:
        """P10 on the compiled fields."""
        return [f for f, m in self.fields.items() if m.required]
