"""DataFrame operators of the fraud pipeline."""
