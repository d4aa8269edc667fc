"""The operators bound to the driver's tables, and the SQL they are checked against."""
