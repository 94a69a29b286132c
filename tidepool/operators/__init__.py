"""DataFrame -> DataFrame operators; see each module's docstring."""
