"""Named queries over the corpus tables, and their DuckDB oracle SQL."""
