"""Column expressions: text, dates, salaries, hashing, row ids and quantiles."""
