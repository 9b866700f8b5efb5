"""The registered queries over the test tables, each beside its SQL equivalent."""
