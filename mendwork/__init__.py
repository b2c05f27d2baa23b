"""Set-based repair, authorised search, workload sampling and run analytics on PySpark."""
