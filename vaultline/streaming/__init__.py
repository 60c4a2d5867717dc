"""Streaming: incremental pickup of landed files."""
