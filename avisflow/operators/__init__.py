"""Reusable DataFrame operators (each is a composition of built-in Spark operators)."""
