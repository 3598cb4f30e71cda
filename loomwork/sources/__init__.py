"""Reading from and publishing to files, tables and databases."""
