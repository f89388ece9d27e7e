"""Column helpers: clocks and calendar arithmetic (dates), business expressions (exprs)."""
