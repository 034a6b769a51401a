"""Composite plans: table specifications, load profiles, table builds,
and skew-safe ordering helpers."""
