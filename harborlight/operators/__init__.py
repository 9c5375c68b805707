"""DataFrame operators behind the four tables."""
