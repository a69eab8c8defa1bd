"""The checked queries: each over whole tables, each with an SQL twin where SQL can say it."""
