"""Readers and writers: requests, log segments, table snapshots, dead letters."""
