"""DuckDB oracle SQL for the registered queries (an independent restatement, used only for checking)."""
