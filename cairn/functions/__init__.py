"""Column expressions: everything here runs inside the JVM, in generated code where Spark has it."""
