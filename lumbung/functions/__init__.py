"""Column expressions: parsing, standardisation, calendar and labels."""
