"""Driver queries over the test tables, each with its oracle SQL where SQL can state it."""
