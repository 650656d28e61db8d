"""DataFrame operators. Column names are parameters; the defaults fit the filings schema."""
