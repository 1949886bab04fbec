"""Where records come from: topics, change logs, relational and file tables."""
