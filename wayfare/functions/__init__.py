"""Column expressions: no UDFs, so every one stays inside whole-stage codegen."""
