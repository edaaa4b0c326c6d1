"""Column functions: every one is a plain expression that runs inside the JVM."""
