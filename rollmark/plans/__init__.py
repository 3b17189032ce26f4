"""How work is laid out on the cluster: sizes, skew, ordered groups, shared folders."""
