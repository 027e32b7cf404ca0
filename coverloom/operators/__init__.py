"""DataFrame-to-DataFrame operators the plans are composed of."""
