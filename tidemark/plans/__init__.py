"""Whole jobs: the refresh run, the export bundle and the registered queries."""
