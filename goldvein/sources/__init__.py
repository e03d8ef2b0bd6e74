"""Feeds, tables, lookups and rejects: everything that reads or writes."""
