"""Readers, writers, the SQL catalog and the named-query runner."""
