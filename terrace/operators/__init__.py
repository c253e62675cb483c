"""DataFrame to DataFrame steps; none of them runs a job."""
