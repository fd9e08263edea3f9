"""Column-level functions. Everything here stays inside JVM code generation except stemming."""
