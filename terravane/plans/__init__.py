"""Whole jobs: extract to tables, vertex dimension, text chunks, model checks."""
