"""Table operations: cleaning, joins, statistics, reshaping, models."""
