"""DataFrame -> DataFrame steps. State and year are key columns; nothing loops over them."""
