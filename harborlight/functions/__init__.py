"""Column expressions: strict JSON picks, times, levels, identities, statuses."""
