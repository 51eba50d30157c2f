"""The checked queries: Spark plans and the SQL each is compared with."""
