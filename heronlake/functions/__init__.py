"""Column functions: text, URLs, times, categories, entities."""
