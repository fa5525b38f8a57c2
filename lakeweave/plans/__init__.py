"""End-to-end layered jobs composed from the operators."""
