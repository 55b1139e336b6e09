"""Structured Streaming: message parsing, alert rules, jobs and health tables."""
