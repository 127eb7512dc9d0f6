"""The series registry, the feature catalog and the registered queries."""
