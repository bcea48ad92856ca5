"""The loads of the star schema, composed from the operators."""
