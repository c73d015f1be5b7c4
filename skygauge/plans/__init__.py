"""The public jobs and queries, composed from sources and operators."""
