"""Where tables come from and go to: files, JDBC, the catalog, sample tables."""
