"""Antibody-repertoire and motif analytics as Spark DataFrame operators."""
