"""Operators for preparing training data: one module for each, and the queries that apply them."""
