"""Column functions of the mappings."""
