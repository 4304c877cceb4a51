"""Training-data operators, each built by the method its module names."""
