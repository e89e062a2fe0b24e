"""Plans of the repertoire engine."""
