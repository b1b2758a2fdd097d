"""Column expressions: parsing, status ladders, health scores and cleaning rules."""
