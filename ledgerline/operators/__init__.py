"""Domain operators: contracts, cleaning, marts, quality, billing, reports."""
