"""Readers and writers of examples, scores, logs, task documents and snapshots."""
