"""Named models: staging, facts, marts, serving queries and data tests."""
