"""Whole flows, the derived test tables, and the catalogue of queries."""
