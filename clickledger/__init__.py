"""Advertising measurement on Spark: validate, link, aggregate, reconcile, serve."""
