"""Jobs that chain the operators: discovery, exploration, risk model, and both together."""
