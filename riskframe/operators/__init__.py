"""DataFrame operators (fit = one aggregate, transform = projection)."""
