"""Operators: ``DataFrame -> DataFrame``, lazy, with key and value columns as parameters."""
