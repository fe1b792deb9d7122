"""Column-expression helpers: all JVM-side, whole-stage-codegen friendly."""
