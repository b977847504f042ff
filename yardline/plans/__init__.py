"""Compositions: the layered run, the quality suite, reports, catalog, source preparation."""
