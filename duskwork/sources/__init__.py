"""Reading tables and parameters, writing new table states."""
