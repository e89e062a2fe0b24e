"""Sources of the repertoire engine."""
