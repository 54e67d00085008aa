"""Repository analytics as Spark jobs: ingest, dedupe, enrich, rank, and report."""
