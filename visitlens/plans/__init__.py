"""Plans: the registered queries, their SQL oracle, and the task job."""
