"""Plans: fixtures over the benchmark tables, the layered job, views and the query catalogue."""
