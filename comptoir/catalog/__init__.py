"""The operators over the test tables, and the SQL their results are checked against."""
