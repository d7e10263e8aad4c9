"""Text and sales analytics as plain Spark jobs: every function takes DataFrames and returns one."""
