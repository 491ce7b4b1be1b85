"""DataFrame operators shared by the table transforms and marts."""
