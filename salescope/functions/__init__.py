"""Column expressions: calendar, price, size and ingredient features."""
