"""DataFrame-to-DataFrame operators the layer plans are composed of."""
