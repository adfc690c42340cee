"""Reading and writing tables, files and fetched pages."""
