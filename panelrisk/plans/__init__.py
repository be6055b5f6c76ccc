"""Whole plans: the table-building job, registered queries and their SQL."""
