"""Reading tables, queries and change feeds."""
