"""Staging, unified sales, star schema, checks, reports and the pipeline."""
