"""Column expressions: calendar, fixed-point numbers, signal labels."""
