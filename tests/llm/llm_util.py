"""Plain-Python statements of the token rules."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def tokens(text):
    return WORD.findall(lower(text))
