"""Support-ticket operators for Spark: check, quarantine, deduplicate, enrich, load, report."""
