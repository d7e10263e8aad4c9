"""Column expressions: field extraction, text features, labels. All of them run inside the JVM."""
