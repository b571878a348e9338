"""Telhado: a PySpark batch engine for property-listing analytics."""
