"""Named report queries; each is a function of (spark, sf_dir) with its parameters as defaults."""
