"""Column functions. Each takes and returns Columns and stays in the JVM unless its docstring says otherwise."""
