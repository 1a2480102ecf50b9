"""Files and JDBC tables."""
