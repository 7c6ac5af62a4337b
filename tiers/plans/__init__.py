"""Composed jobs: ad-hoc analysis, silver and gold refresh, and the run from feeds to gold."""
