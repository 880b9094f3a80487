"""Column builders and the size checks that operators share."""
