"""Reading and writing: delimited readings, hourly tables, scoring requests, run records."""
