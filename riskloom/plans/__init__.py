"""Named query plans: the query registry, oracle SQL and end-to-end jobs."""
