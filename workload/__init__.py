"""Transactions made from the test tables, and the queries and SQL checked over them."""
