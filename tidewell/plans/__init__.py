"""Entity plans and jobs."""
