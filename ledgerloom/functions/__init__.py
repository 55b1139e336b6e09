"""Column-level building blocks: pure expressions, no actions, no Python UDFs."""
