"""Column -> Column expressions; all native, so they stay inside generated code."""
