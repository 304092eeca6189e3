"""Registered queries: the operators applied to whole tables, with the same in SQL."""
