"""Column-expression builders (all JVM-side built-ins, no UDFs)."""
