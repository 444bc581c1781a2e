"""Readers and writers: tables, snapshots, nested JSON, HTML."""
