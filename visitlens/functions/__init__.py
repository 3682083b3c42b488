"""Column functions: times, text and predicates. All of them run in the JVM."""
