"""Content-engagement analytics as Spark jobs: enrich, measure, serve, ingest and check."""
