"""Column-to-Column masking functions. All of them are NULL -> NULL and JVM-side."""
