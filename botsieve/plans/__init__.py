"""Jobs and the registered queries with their oracle SQL."""
