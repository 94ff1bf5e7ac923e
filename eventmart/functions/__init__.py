"""Column expressions shared by the Table-to-table operators.."""
