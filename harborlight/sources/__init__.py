"""Landed files in, partitioned tables out."""
