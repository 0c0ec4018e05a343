"""Column in, column out. Everything here stays in the JVM: no Python functions run on rows."""
