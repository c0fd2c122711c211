"""Whole jobs: writing a tree, updating one, the stages' contracts, and the registered queries."""
