"""Functions of the repertoire engine."""
