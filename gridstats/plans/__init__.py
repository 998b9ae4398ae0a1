"""How work is laid out on the cluster: size checks, hot keys, and the whole pipeline."""
