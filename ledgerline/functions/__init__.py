"""Column builders: built-in expressions only, so every one stays in the JVM."""
