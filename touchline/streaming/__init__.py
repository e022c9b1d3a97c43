"""Empty on purpose: every input here is a finished file or table, so there is no streaming operator to offer."""
