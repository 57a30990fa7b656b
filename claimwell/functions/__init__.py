"""Column expressions: file names, quality rules, masking, derived claim fields, money."""
