"""DataFrame to DataFrame operators, the same for batch and stream unless stated."""
