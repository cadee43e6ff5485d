"""DataFrame -> DataFrame operators on (entity, period) panels."""
