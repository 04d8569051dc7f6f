"""Report plans and the operator-level check queries."""
