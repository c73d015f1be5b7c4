"""DataFrame operators: baselines, scoring, refinement, contracts, paging."""
