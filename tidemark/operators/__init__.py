"""Table operators: transforms, the rule model and engine, quality reports, join and marts."""
