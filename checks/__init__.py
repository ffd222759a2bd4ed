"""Registered queries over the driver's tables, and the SQL that checks them."""
