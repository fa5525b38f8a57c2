"""Column-level building blocks: no UDFs, everything stays inside codegen."""
