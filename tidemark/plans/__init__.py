"""Whole runs: the pipeline over tables, and the adapter that shapes other tables for it."""
