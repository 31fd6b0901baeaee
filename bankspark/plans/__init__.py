"""The bank's models: staging, enrichment, dimensions, facts, marts, serving views."""
