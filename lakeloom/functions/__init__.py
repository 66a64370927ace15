"""Column-level building blocks (all built-in Spark expressions, codegen friendly)."""
