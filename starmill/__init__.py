"""Star-schema ELT, data-quality suites and dashboard datasets as Spark jobs."""
