"""Partitioned writers, external tables and staging views."""
