"""Loan-portfolio analytics written as plain PySpark DataFrame work."""
