"""Where comparison tables are written to and read from."""
