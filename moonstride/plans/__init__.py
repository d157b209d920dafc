"""The models: staging, intermediate, facts and dimensions."""
