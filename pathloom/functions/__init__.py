"""Column functions: geometry, boxes, times, labels."""
