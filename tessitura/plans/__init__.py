"""Views over the provided tables, jobs, and the query catalogue."""
