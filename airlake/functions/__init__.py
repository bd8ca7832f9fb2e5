"""Column expressions: everything here stays on the JVM and inside whole-stage codegen."""
