"""Column functions and row-wise (shuffle-free) transforms."""
