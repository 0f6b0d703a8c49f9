"""Readers, writers and the mapping of input tables to canonical columns."""
