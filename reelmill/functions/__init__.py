"""Column expressions. All of them stay inside the JVM except the p-value of the t-test."""
