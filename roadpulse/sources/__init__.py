"""Where data comes from: topic, files, lake, stored tables, database."""
