"""DataFrame-to-DataFrame operators over the paper catalog."""
