"""Raw tables: their layout and readers."""
