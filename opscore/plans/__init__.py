"""Finished queries composed from the operators."""
