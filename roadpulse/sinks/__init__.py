"""Where results go: lake, stored tables, database, topic."""
