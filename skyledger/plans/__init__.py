"""Multi-step pipelines that compose operators and run Spark actions."""
