"""Column functions: everything here returns a Column and stays inside code generation."""
