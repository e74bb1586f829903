"""Check data and check queries: flat sales rows over the given tables, and the SQL
whose results the jobs are compared with."""
