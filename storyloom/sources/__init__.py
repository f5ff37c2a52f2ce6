"""Readers: markdown stories, table exports, transcripts, usage logs, metadata trees, responses."""
