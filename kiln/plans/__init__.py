"""End-to-end chains (the reference's four stages) and the query catalog."""
