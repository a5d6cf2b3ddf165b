"""Operators for preparing large text corpora, and the queries that apply them."""
