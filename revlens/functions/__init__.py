"""Column functions: everything here stays an expression Catalyst can see."""
