"""Readers and writers for feeds, the trip table and reports."""
