"""Column functions: typing, conforming, ratios and number extraction."""
