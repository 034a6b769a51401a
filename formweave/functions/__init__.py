"""Scalar column functions (the S-ops): pure ``Column -> Column`` builders."""
