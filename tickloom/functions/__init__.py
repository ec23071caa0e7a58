"""Column functions and the distributed series primitives."""
