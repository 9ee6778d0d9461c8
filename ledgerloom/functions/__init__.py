"""Column expressions; everything here is ``Column -> Column``."""
