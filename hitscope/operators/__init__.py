"""DataFrame operators: cleaning, geolocation, enrichment, reports, windows, measures."""
