"""DataFrame-to-DataFrame operators over the observation table and its profiles."""
