"""Column expressions: times, delay classes, labels and feed statuses."""
