"""Streaming entry points: the batch operators applied to arriving files."""
