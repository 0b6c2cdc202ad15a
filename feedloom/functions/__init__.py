"""Column functions; everything but the vector codec stays in the JVM."""
