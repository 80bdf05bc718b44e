"""Document analytics on Spark: text, pages, quality, merging, telemetry and state as DataFrame operators."""
