"""Column-level helpers: every function here returns a Column and stays on the JVM."""
