"""Column functions: text, JSON values, times, hours and money."""
