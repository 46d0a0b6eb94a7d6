"""Reading and writing files, tables and message streams."""
