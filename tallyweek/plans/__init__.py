"""The sales panel and the registered queries with their check SQL."""
