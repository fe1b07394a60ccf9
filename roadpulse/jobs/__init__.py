"""Programs for ``spark-submit``; the master comes from the submit command."""
