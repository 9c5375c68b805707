"""Structured Streaming forms of the event watch and the log follow."""
