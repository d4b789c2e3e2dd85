"""Column functions and the fixed code tables of the structural domain."""
