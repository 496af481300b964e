"""End-to-end steps and the registered queries."""
