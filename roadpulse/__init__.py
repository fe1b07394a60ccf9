"""Road-sensor analytics on Spark: ingest, indicators, checks, publishing, dashboards."""
