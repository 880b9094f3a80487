"""Files, named tables, previews and the tables derived from the test data."""
