"""Jobs and views built from the operators."""
