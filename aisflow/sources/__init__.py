"""Readers for position reports, ports and day listings."""
