"""Plans: sinks and the end-to-end build / refresh / alert runs."""
