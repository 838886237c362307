"""Column-to-column functions; all of them run inside the JVM."""
