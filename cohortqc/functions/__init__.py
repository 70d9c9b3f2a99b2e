"""Column expressions: everything here maps columns to columns and runs inside the JVM unless it says otherwise."""
