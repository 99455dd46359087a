"""Column-expression helpers (JVM-side, code-generated; no Python UDFs)."""
