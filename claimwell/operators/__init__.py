"""Table operators: enrichment, summaries, deduplication, registry, reports, comparisons."""
