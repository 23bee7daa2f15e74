"""Whole analyses built from the operators, and the query catalogue."""
