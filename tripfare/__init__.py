"""Trip-record quality, demand and fare analytics, expressed as Spark plans."""
