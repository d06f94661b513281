"""Writing targets: commits, tables, staging and catalog registration."""
