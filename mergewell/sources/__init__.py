"""Reading tables of entities and of known links, and writing results."""
