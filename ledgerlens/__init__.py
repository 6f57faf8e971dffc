"""ledgerlens: account-activity analytics as plain Spark DataFrame transformations."""
