"""DataFrame-to-DataFrame operators over all series and months at once."""
