"""tillgrid package."""
