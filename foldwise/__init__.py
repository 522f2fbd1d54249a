"""Cross-validated, two-level ensemble modelling on Spark tables."""
