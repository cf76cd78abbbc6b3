"""The registered queries and the tables and views they read."""
