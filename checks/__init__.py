"""Checks on the given tables: a match table derived from them, the registered queries and their SQL oracles."""
