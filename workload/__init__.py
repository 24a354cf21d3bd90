"""Registered queries: each operator on the given tables, with the SQL it must agree with."""
