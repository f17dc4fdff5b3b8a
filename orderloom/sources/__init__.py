"""CSV and raw-snapshot inputs, and the tables results are written to."""
