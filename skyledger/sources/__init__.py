"""Sources: landed API documents, raw tables, location seed."""
