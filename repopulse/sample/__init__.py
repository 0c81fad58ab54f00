"""Raw-shaped records over the supplied test tables, and the SQL that checks the queries."""
