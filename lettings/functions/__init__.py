"""Column-to-column helpers; everything stays inside the JVM."""
