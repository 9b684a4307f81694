"""Column expressions over text; everything here stays inside the JVM."""
