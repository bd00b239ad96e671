"""The models: staging, intermediate, core star schema, marts, KPIs and the full build."""
