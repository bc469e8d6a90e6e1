"""End-to-end pipeline, catalog setup and the query registry."""
