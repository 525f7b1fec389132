"""The registered queries, their inputs from the given tables, and their SQL oracles."""
