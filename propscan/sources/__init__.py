"""Readers and writers: snapshots, pages, logs, reports."""
