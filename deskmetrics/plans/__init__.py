"""Report compositions (``reports``), parameterised SQL texts (``sql``) and the registry of
checked queries over the test data (``catalog``)."""
