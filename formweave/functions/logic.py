"""Branching-logic text as column expressions.

Logic such as ``[race(2)] = '1' and ([baseline][ibd] >= 5 or [sex]<>"")``
references variables in brackets; a checkbox option carries its code in
parentheses; adjacent brackets are one event-qualified variable, written
``event:var`` in the graph.  All readings come from one scan over the tokens
of the text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens of branching logic.  One scan from left to right
# takes the first alternative that fits, so what stands in quotes is a string
# whatever it holds, and a comparison keeps its literal with its sign and point.
STRING = r"'[^']*'|\"[^\"]*\""
VARIABLE = r"(?:\[\w+(?:\(-?\w+(?:\.\w+)?\))?\]\s*)+"
OPERATOR = r"<>|>=|<=|!=|=|<|>"
LITERAL = r"[+-]?\.?\w+(?:\.\w+)*"      # a number or a bare word
TOKEN = rf"(?:{OPERATOR})\s*(?:{STRING}|{LITERAL})|{STRING}|{VARIABLE}|{OPERATOR}|\w+(?:\.\w+)*|[()]"
_OPERATOR_START = rf"^({OPERATOR})\s*"


def logic_scan(logic: Column) -> Column:
    """The tokens of the text, in order, as an array of strings.  A comparison
    with a literal is one token (``>= -1.5``); a character that belongs to
    nothing, such as a quote never closed, is skipped."""
    return F.regexp_extract_all(logic, F.lit(rf"({TOKEN})"), 1)


def _kind(token: Column) -> Column:
    return (F.when(token.startswith("["), "variable")
            .when(token.rlike(_OPERATOR_START + "$"), "operator")
            .when(token.rlike(_OPERATOR_START), "comparison")
            .when(token.rlike("^['\"]"), "string")
            .when(token.rlike(r"^[()]$"), "paren")
            .when(token.rlike("^(?i:and|or|not)$"), "gate")
            .otherwise("word"))


def unquoted(literal: Column) -> Column:
    """A literal without its quotes."""
    return F.regexp_replace(literal, "(?s)^(['\"])(.*)\\1$", "$2")


def logic_tokens(logic: Column) -> Column:
    """``array<struct<kind, op, text>>``: variables by name (``event:var(code)``),
    comparisons with their operator and bare value, strings without quotes."""
    def one(token: Column) -> Column:
        kind = _kind(token)
        op = F.regexp_extract(token, _OPERATOR_START, 1)
        text = (F.when(kind == "variable", variable_name(token))
                .when(kind == "comparison", unquoted(F.regexp_replace(token, _OPERATOR_START, "")))
                .when(kind == "string", unquoted(token))
                .when(kind == "gate", F.lower(token)).otherwise(token))
        return F.struct(kind.alias("kind"), F.when(op != "", op).alias("op"), text.alias("text"))
    return F.transform(logic_scan(logic), one)


def variable_name(raw: Column) -> Column:
    """``[ev] [var(2)]`` -> ``ev:var(2)``."""
    joined = F.regexp_replace(F.trim(raw), r"\]\s*\[", ":")
    return F.regexp_replace(joined, r"^\[|\]\s*$", "")


def logic_variables(logic: Column) -> Column:
    """Array of referenced variables, in text order."""
    return F.transform(F.filter(logic_scan(logic), lambda t: t.startswith("[")), variable_name)


def logic_values(logic: Column) -> Column:
    """Array of compared values, quotes removed (``""`` gives ``''``)."""
    found = F.filter(logic_scan(logic), lambda t: t.rlike(_OPERATOR_START + r"\S"))
    return F.transform(found, lambda t: unquoted(F.regexp_replace(t, _OPERATOR_START, "")))


def has_logic(logic: Column) -> Column:
    """Logic present: not null and not blank."""
    return logic.isNotNull() & (F.trim(logic) != F.lit(""))
