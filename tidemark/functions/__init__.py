"""Column functions: every one takes and returns Columns, so plans stay inside codegen."""
