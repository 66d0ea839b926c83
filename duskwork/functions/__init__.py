"""Column helpers: text rules, dates and date keys."""
