"""Column expressions. Everything here is built in and runs inside the JVM."""
