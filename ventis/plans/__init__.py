"""Jobs that chain operators end to end, and the catalogue of named queries."""
