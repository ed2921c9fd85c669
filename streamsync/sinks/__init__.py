"""File, catalog and JDBC sinks."""
