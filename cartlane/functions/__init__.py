"""Column functions: seeded draws, money, text and time."""
