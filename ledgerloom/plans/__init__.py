"""Composed tables: silver, gold, regulatory, analytical queries, serving views, batch jobs."""
