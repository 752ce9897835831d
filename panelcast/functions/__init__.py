"""Column-level functions: every one takes and returns a ``Column`` and stays inside code generation."""
