"""Graph operators on edge tables (a, b, m): undirected, a < b, m parallel edges."""
