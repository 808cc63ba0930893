"""End-to-end models, dashboard queries and measures built from the operators."""
