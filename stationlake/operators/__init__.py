"""DataFrame → DataFrame operators of the observation model."""
