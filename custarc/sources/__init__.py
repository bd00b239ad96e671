"""Raw inputs: the five source tables, file loading, and adapters from other schemas."""
