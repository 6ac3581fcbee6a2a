"""Technical features as column builders and one grouped-map recursion."""
