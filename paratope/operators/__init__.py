"""Operators of the repertoire engine."""
