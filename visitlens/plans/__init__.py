"""Whole jobs: from the input tables to result tables ready to store."""
