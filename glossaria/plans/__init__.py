"""Whole plans: the enriched forms table and the build of all collections."""
