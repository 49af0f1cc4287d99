"""Star-schema lake job on PySpark: JSON song metadata and activity logs in, tables and reports out."""
