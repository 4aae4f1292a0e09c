"""Column-level functions (all JVM-side expressions, no Python UDFs)."""
