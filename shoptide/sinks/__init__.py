"""Where results go: keyed tables, topics, relational tables, daily log files."""
