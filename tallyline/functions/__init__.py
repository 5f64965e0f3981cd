"""Column expressions shared by the operators. All of them stay on the JVM side."""
