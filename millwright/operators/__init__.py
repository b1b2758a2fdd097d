"""DataFrame-to-DataFrame operators: merges, ordered analytics, audits, enrichment."""
