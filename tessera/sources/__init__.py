"""Readers, writers and the derived inputs of the registered queries."""
