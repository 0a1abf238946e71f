"""Projects keyed event streams into query-ready read-model tables on Spark."""
