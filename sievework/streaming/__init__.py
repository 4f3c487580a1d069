"""Structured Streaming forms of ingest, counting, dedup and guardrails."""
