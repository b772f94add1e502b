"""Reading delimited landing files, tables and parameterised queries."""
