"""DataFrame -> DataFrame operators, none of which runs an action."""
