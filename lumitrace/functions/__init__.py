"""Column expressions. Everything here runs in the JVM; nothing is a Python UDF."""
