"""Where documents come from and where tables are kept."""
