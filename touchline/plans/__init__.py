"""Complete queries: the reports, the analysis views, the table of facts, and the batch jobs."""
