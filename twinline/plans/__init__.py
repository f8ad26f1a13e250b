"""Plan helpers: tables in the shared folder."""
