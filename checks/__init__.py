"""The registered queries, each next to the SQL that gives the same rows."""
