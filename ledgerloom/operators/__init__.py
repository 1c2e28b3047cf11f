"""DataFrame operators: explicit keys, explicit order, no actions."""
