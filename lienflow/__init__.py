"""Spark jobs for ingesting, normalizing, upserting and analysing lien filings."""
