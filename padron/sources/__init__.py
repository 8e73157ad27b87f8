"""Reading of monthly files, catalogs and tables; writing of tables."""
