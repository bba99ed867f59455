"""Column functions: expressions from columns to a column, no DataFrame needed."""
