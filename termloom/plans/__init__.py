"""Whole jobs: building, saving and loading an index, searching it, comparing solvers."""
