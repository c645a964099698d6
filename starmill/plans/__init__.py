"""The jobs: star views, marts, check suites, history, panels and the pipeline."""
