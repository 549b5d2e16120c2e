"""DataFrame operators, grouped as in the survey's inventory (section 2)."""
