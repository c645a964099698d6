"""Column expressions and schema rules shared by the jobs."""
