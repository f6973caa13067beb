"""Reports and whole loads put together from the operators."""
