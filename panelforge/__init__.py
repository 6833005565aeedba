"""A registry panel engine on PySpark: monthly dumps in, change ledger, panel and reports out."""
