"""DataFrame -> DataFrame operators of the scenario pipeline."""
