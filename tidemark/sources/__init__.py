"""Reading and writing: tables, the lake, adapters of the test tables."""
