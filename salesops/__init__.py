"""Sales and finance analytics on PySpark: operators, reports, loaders, streams."""
