"""Column helpers: scoring rules, calendar arithmetic, text clean-up."""
