"""Data operators: pure ``DataFrame -> DataFrame`` functions."""
