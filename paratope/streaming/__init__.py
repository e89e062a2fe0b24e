"""Streaming of the repertoire engine."""
