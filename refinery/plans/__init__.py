"""Query plans built from the operators: pipelines, reports and role mappings."""
