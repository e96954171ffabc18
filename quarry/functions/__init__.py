"""Column expressions shared by the operators (JVM-side, codegen friendly)."""
