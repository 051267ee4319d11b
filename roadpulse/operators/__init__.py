"""Single analytic steps, each DataFrame -> DataFrame."""
