"""DataFrame operators: metadata ops, recoding, checkbox unfolding,
typing, validation, graph and asset tables."""
