"""Table sources: warehouse readers and the test fixture."""
