"""functions of the engine."""
