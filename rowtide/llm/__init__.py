"""Operators for preparing large text corpora, and the registered queries that apply them."""
