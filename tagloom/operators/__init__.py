"""Lookups, merges, aggregates, clustering, classification and catalogue jobs."""
