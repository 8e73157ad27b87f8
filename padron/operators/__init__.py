"""DataFrame -> DataFrame operators on registry panels."""
