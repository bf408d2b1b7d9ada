"""Event sources and the tables of each layer."""
