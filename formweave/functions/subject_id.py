"""Subject identifiers.

An identifier is ``proband`` or ``proband<delim>code``; the code names the
family relation of the sample's donor to the proband.  More than two parts
and the code ``1`` are invalid.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Allowed delimiters, invalid relation codes, relation labels.
VALID_DELIMS = (".", "-")
INVALID_RELATIONS = ("1",)
RELATION_LABELS = {
    "0": "proband",
    "2": "mother",
    "3": "father",
    "4": "sibling",
    "5": "sibling",
    "6": "sibling",
    "7": "sibling",
}
NO_CODE_LABEL = "proband"


def _relation_map() -> Column:
    kv = []
    for k, v in RELATION_LABELS.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


def parse_subject_id(c: Column, delim: str = ".") -> Column:
    """``struct<proband_id, relation_code, relation, valid>``."""
    if delim not in VALID_DELIMS:
        raise ValueError(f"delimiter must be one of {VALID_DELIMS}, got {delim!r}")
    parts = F.split(c, re.escape(delim))
    n = F.size(parts)
    code = F.when(n == 2, F.get(parts, 1))
    relation = F.when(n == 1, F.lit(NO_CODE_LABEL)).when(n == 2, F.element_at(_relation_map(), code))
    valid = (n <= 2) & F.coalesce(~code.isin(*INVALID_RELATIONS), F.lit(True))
    return F.struct(
        F.when(n == 1, c).when(n == 2, F.get(parts, 0)).alias("proband_id"),
        code.alias("relation_code"),
        relation.alias("relation"),
        F.when(c.isNotNull(), valid).alias("valid"),
    )
