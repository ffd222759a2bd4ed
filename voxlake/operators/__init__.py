"""DataFrame -> DataFrame operators; the same function serves batch and stream where it can."""
