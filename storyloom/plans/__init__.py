"""Plans made of several operators: the extraction pipeline, reports, rebuilds, the query catalogue."""
