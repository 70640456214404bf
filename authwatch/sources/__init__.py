"""Readers and writers: log files, the message bus and Parquet tables."""
