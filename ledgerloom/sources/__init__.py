"""Schema-first readers and the writers that go with them."""
