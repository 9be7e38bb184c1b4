"""Column-expression builders (JVM-side, codegen'd; no Python UDFs)."""
