"""Column expressions: numbers, text, URLs, nested values and dates. All of them stay inside the JVM."""
