"""End-to-end plans (bronze -> silver -> gold) over an inbox or the fixture tables."""
