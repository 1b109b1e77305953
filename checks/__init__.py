"""The driver's queries over its shared tables, each next to the SQL it must equal."""
