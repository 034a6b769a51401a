"""Small dictionaries for tests."""

from __future__ import annotations


def dictionary(spark, rows):
    """A prepared dictionary from ``(ord, field, ftype, form, hdr, label, choices,
    vtype, vmin, vmax, logic, required)`` tuples."""
    from formweave.sources.dictionary import prepare_dictionary
    schema = ("ord bigint, field string, ftype string, form string, hdr string, label string, "
              "choices string, vtype string, vmin string, vmax string, logic string, required string")
    return prepare_dictionary(spark.createDataFrame(rows, schema))


def row(ord_, field, ftype, form=None, hdr=None, label=None, choices=None, vtype=None, vmin=None,
        vmax=None, logic=None, required=None):
    return (ord_, field, ftype, form, hdr, label, choices, vtype, vmin, vmax, logic, required)
